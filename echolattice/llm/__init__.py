"""Operators for training-data pipelines over ``documents``, ``conversations`` and ``benchmark``.

Nothing else in the library imports this subpackage.
"""
