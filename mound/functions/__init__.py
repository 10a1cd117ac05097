"""Column-level functions: cleaning, labels, calendars, dictionary encoding."""
