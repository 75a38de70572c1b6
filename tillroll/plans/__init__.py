"""The warehouse, its views, its quality checks and its analysis, composed from the operators."""
