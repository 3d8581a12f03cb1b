"""Column expressions: exact decoding, dates, text, addresses and record shapes."""
