"""Operators for preparing large training corpora, one module each.

Nothing outside this folder imports it; ``queries`` registers the operators.
"""
