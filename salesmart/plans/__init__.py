"""Composite plans: silver/quarantine, gold, bronze, the job and the query catalog."""
