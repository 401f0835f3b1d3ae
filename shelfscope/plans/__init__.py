"""Tables and reports: DataFrames in, one DataFrame out."""
