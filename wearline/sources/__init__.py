"""Readers and writers: sensor and truth text, the tables, other databases."""
