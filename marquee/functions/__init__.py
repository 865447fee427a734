"""Column-level rules: text cleaning, tokenising and scoring expressions."""
