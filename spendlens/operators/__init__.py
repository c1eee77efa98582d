"""DataFrame operators: cleaning, profiling, splitting, lookups, metrics, features, models."""
