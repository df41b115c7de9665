"""Training-data operators (one module per operator) and their queries.

Nothing outside this folder imports it except ``__spark_entry__.py`` (guarded)
and ``corpus_pipeline.py``.
"""
