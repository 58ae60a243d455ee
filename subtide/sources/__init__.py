"""Table schemas, readers and writers, and adapters from the star-schema test tables."""
