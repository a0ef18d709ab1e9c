"""Composed products and the registered queries."""
