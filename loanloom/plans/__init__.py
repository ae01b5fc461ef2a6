"""Composite tables and answers built from the operators."""
