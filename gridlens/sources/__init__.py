"""Label files, dataset layouts, urls and caches as DataFrames, and back."""
