"""Whole builds: silver, star schema, metrics, monitoring, loads."""
