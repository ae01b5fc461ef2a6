"""Text extracts and messages derived from the generated parquet tables.

They stand in for the messy sources the engine reads. Every rule is plain integer
and date arithmetic, repeated independently in SQL by ``loanloom.oracles``.
"""
