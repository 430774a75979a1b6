"""Curated entities, star schema, analytic views, reports and the two drivers."""
