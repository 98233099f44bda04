"""Column expressions: text, dates, places, nested records and HTML."""
