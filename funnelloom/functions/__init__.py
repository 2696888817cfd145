"""Column functions: dates, text, ratios. No UDFs."""
