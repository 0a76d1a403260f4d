"""Table operators: staging, merge, variance, KPI cuts, features, models, scoring, quality."""
