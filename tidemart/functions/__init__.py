"""Column functions: times, text and word splitting."""
