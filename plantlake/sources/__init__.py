"""Table declarations, extracts, tables on shared storage and audits."""
