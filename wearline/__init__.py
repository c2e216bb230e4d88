"""Run-to-failure analytics for multi-sensor panels, written as Spark DataFrame jobs."""
