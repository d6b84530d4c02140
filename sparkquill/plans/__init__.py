"""Query catalogue: composed plans with their SQL oracles."""
