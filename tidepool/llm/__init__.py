"""Operators for preparing training text at scale.

One module per operator; ``catalog`` registers one query per operator. Nothing
outside this folder imports it except ``__spark_entry__`` (which adds the
queries only when the folder is there) and ``corpus_pipeline``.
"""
