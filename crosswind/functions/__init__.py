"""Column expressions: clocks, labels, calendar parts, text and geometry."""
