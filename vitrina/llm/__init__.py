"""Training-data operators: one module per operator, queries in ``vitrina.llm.queries``.

Nothing outside this package imports it, except ``__spark_entry__.py`` (behind a
guard) and ``corpus_pipeline.py``.
"""
