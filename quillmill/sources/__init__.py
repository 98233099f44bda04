"""Readers, writers, the post store and the batch ledger."""
