"""Relational operators: slot assignment, funnel aggregation, membership, profiles."""
