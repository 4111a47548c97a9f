"""finlake sources."""
