"""Column expressions: header fields, boilerplate, tokenisers."""
