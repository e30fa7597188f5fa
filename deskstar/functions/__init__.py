"""Column expressions: text, time, numbers and labels."""
