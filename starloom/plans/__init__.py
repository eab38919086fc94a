"""Logical plans: cleaning, star schema, publishing, audit, metrics, analyses."""
