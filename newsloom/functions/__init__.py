"""Column functions: text, URLs, dates, HTML and arrays."""
