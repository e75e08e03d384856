"""Operators of a training-data pipeline over documents, pages and embeddings.

Nothing outside this folder imports it, apart from the guarded registration in
``__spark_entry__.py`` and ``corpus_pipeline.py``. Each module holds one
operator with a general interface and the thin ``opN_<name>`` query over it;
``registry`` lists the queries and their SQL.
"""
