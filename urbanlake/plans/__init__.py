"""Jobs that read, transform and write tables."""
