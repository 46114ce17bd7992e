"""Column helpers: each takes and returns Columns, so they run inside generated code."""
