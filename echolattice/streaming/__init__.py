"""Structured Streaming forms of the ledger and product operators."""
