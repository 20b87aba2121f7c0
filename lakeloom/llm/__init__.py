"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface; :mod:`lakeloom.llm.queries` applies them to
the given tables with production parameters.
"""
