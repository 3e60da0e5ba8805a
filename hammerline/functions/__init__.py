"""Column expressions: measures, text, parsing of scraped fields."""
