"""Trip records from raw monthly files to a checked star schema, as Spark jobs."""
