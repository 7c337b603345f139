"""Operators for large-scale training-data preparation.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own general interface; ``queries`` binds them to the driver's
tables and ``corpus_pipeline.py`` at the repository top chains some of them.
"""
