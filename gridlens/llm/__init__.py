"""Operators for preparing language-model training text.

Nothing outside this folder imports it; ``__spark_entry__`` adds its queries
only when it can be imported.
"""
