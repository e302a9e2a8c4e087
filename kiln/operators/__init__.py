"""Table-in / table-out operators, grouped by family."""
