"""Column expressions: text cleaning and reply quality."""
