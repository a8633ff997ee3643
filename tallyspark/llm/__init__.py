"""Training-data operators: dedup, packing, search, labels, redaction, archives.

Nothing else in the library imports this subpackage; its queries and their
SQL are registered from ``tallyspark.llm.queries``.
"""
