"""Column functions: dates, numerics, classification rules."""
