"""Relational models: staging projections, gold marts and data-quality checks."""
