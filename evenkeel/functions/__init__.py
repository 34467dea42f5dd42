"""Column functions: text cleaning, keys, seeded draws, URL handling."""
