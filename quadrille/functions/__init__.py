"""Column expressions: text keys, numbers, zone codes, rules and geometry."""
