"""Column functions: text in, columns out, no DataFrame needed."""
