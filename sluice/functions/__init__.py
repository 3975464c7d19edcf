"""Column-level helpers: casts, schema walks, hashing, softmax losses."""
