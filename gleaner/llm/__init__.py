"""Operators for preparing large training corpora."""
