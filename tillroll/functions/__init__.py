"""Column functions: money, keys, text, weeks and code labels."""
