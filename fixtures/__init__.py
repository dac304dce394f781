"""Maps the benchmark tables onto the domain tables and holds the check SQL."""
