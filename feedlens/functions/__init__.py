"""Column expressions: text, nested arrays, redaction, geometry, codecs."""
