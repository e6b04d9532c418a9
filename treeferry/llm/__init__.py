"""Operators for large text corpora, each over DataFrames with the columns of ``documents`` or ``pages``.

Nothing outside this package imports it but the registration of its queries.
"""
