"""finlake plans."""
