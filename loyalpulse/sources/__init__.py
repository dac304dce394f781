"""Input schemas and the tables a run reads and writes."""
