"""Operators that prepare training data for language models.

Nothing else in the library imports this package. Each module holds one
operator; ``queries`` registers them and holds their check statements.
"""
