"""finlake streaming."""
