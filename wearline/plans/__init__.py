"""Jobs a scheduler runs, and the queries over the driver's tables."""
