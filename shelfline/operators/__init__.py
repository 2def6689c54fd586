"""Table-to-table operators, one module per report family."""
