"""Readers: topics, payment requests, outbox, committed tables."""
