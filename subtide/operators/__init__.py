"""The analytics operators: DataFrames in, one lazy DataFrame out."""
