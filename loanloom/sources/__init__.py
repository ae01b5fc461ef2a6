"""Readers, writers and stored layers."""
