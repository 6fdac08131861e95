"""Jobs that read tables, call operators and write tables."""
