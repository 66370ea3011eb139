"""Keep calendars of upcoming stock listings correct across many sources, on Spark."""
