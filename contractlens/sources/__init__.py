"""Raw files, calendar and stored tables."""
