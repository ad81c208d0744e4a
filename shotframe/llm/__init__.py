"""Operators for training-data corpora (documents, pages, benchmark, labels).

Each module holds one operator with its own general interface; ``queries``
holds the thin registered queries over the given tables.  Nothing else in
the library imports this subpackage.
"""
