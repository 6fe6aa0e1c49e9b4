"""Training-data operators: tokenizing, filtering, deduplication and sharding of text corpora.

Nothing else in the package imports this subpackage.
"""
