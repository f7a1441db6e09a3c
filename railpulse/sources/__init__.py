"""Readers: tables, landed JSON envelopes, file listings, event topics, dimensions."""
