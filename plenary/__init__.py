"""Plenary: DataFrame operators for bills, roll-call votes, members and districts."""
