"""Training-data operators: scoring, packing, search, dedup, archives, filters, mixing, sharding.

Nothing else in the library imports this package; ``__spark_entry__`` adds its
queries when it can be imported.
"""
