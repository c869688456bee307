"""SQL that computes the same results on another engine, for comparison."""
