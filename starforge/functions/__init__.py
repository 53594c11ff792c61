"""Column expressions: business rules, calendar parts and exact ratio arithmetic."""
