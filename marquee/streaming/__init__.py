"""Candidate evaluation over a stream of incoming candidate files."""
