"""Training-data operators: one module per operator, general interfaces.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
``registry.QUERIES`` holds the registered queries, ``registry.ORACLE`` their SQL.
"""
