"""Logical plans: cleaning, dimension and fact loads, audits, analytics."""
