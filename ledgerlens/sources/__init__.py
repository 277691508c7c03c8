"""Readers, adapters and the table store."""
