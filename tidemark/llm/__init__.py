"""Training-data pipeline operators (quality, tokens, dedup, packing, sharding, search).

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries only when it can be imported.
"""
