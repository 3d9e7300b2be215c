"""Training-data pipeline operators (deduplication, packing, mixing, ...).

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries when it is present.
"""
