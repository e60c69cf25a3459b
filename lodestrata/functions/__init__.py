"""Column expressions: parsing, calendar, weather and conditional measures."""
