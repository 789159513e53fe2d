"""Training-data operators: scans, near-duplicate joins, search, mixing, packing and file formats.

One module per operator; ``queries`` holds the registered queries and their SQL. Nothing
outside this package imports it.
"""
