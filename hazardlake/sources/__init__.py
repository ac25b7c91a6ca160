"""Readers, writers and saved parameters."""
