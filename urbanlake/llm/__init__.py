"""Operators on training corpora and their queries; nothing else in the library imports this package."""
