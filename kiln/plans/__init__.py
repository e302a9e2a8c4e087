"""Multi-operator plans and the query catalogue."""
