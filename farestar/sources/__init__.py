"""Files in and out: the month calendar, landing, the tolerant raw reader, tables."""
