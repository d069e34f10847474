"""Composed jobs (pipeline runs, serving SQL) and the query catalogue."""
