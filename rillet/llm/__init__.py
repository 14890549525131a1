"""Training-data operators: filters, counts, sharding, dedup, mixing, packing.

One module per operator, ``queries.py`` for the registered ``opN_*`` queries
and their SQL. Nothing outside this package imports it.
"""
