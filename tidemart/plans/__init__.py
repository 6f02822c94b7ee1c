"""Chains of operators over the input tables, and the queries that check them."""
