"""Readers, writers and table views."""
