"""Operators for large training corpora: one module per operator, plus ``queries``.

Nothing else in the library imports this subpackage.
"""
