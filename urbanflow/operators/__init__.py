"""Relational operators: quality rules, routing, enrichment, sequencing, reports, fusion, models."""
