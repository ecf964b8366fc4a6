"""Column helpers: money, ratios, calendar, text."""
