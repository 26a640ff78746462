"""Stage plans, the deterministic fixture and the query catalogue."""
