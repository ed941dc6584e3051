"""Input schemas, readers and the adapters for the test tables."""
