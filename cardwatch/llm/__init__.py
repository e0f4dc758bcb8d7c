"""Operators on training text and embeddings. Nothing else in the library imports this package."""
