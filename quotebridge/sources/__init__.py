"""Readers of the landed feeds and of the remote trading system."""
