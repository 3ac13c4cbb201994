"""Operators for training-data pipelines over ``documents (doc_id, text, lang, source, n_chars)``.

Nothing else in the library imports this subpackage.
"""
