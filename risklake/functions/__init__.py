"""Column expressions: tolerant parsing, text cleaning, bands, exact money."""
