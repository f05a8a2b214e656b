"""Column expressions: exact arithmetic, calendar keys, labels, lenient parsing."""
