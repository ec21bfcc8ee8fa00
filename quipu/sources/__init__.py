"""Readers, writers and the versioned ledger snapshot."""
