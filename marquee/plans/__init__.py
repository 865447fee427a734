"""Composed plans: the catalogue job, registered queries, oracle SQL, lineage cuts."""
