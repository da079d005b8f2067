"""User-facing jobs: DataFrames in, DataFrames out, nothing executed."""
