"""Reading, extracting and writing records."""
