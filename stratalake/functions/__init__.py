"""Column builders: modular draws, bands, dates, identifiers, text and privacy rules."""
