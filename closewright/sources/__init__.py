"""Readers, writers, dataset contracts and the sample ledger views."""
