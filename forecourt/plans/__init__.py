"""Marts: compositions of the operators."""
