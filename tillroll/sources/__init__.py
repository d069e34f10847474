"""Inputs: the supplied test tables, the sales adapter, landing files."""
