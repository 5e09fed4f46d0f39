"""Operators of a training-data pipeline (texts, conversations, embeddings).

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface; ``queries`` registers the operators over
whole tables.
"""
