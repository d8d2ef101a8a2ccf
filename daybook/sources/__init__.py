"""Readers: file listings, CSV batches, file profiles, notifications, tables."""
