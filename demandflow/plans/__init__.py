"""End-to-end plans: feature tables (V1, V2, NB), models, the query registry."""
