"""Column expressions: null rules, bands, risk rules."""
