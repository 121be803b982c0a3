"""Readers: files, databases, logs, messages, paged sources, query packs."""
