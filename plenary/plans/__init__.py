"""Whole jobs composed from the operators, one lazy plan each."""
