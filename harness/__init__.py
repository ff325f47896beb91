"""Runs the operators on the driver's tables and states the expected result in SQL."""
