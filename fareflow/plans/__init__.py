"""Table-to-table jobs made of the operators."""
