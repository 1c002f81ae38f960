"""Operators for preparing training data of language models.

Ten operators (``opN_...`` queries) and the corpus pipeline.  Nothing else in
the library imports this subpackage.
"""
