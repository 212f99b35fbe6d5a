"""Composite plans: the full build, the query catalogue and its SQL oracle."""
