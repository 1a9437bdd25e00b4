"""Column functions: keys, values, vectors and text."""
