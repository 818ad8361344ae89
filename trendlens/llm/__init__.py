"""Training-data operators: thirteen corpus-scale operators and the queries that apply them.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.  Each module holds one
operator with a general DataFrame interface and the thin ``opN_*`` query that derives the
reported digest columns from it.
"""
