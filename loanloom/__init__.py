"""Lending analytics and support-message triage as Spark table operators."""
