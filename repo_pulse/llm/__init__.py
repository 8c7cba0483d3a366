"""Training-data operators: thirteen operators on documents, vectors and conversations and their queries.

Nothing outside this subpackage imports it, apart from the guarded import in
``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
