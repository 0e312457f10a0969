"""Training-data operators: near-duplicate joins, training-order shards,
embedding near-duplicates, source mixing, toxicity, exact top-k search,
pseudonyms, a compression quality classifier, byte-level BPE and language ID.

Nothing else in the library imports this subpackage.
"""
