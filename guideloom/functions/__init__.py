"""Column functions on sequences and votes."""
