"""DataFrame operators: projections and predicates (P), aggregates (A, T2) and
partition maintenance (M, T1)."""
