"""Training-data operators: mixing, filtering, deduplication, extraction, sharding.

Nothing outside this subpackage (but for the guarded import in
``__spark_entry__.py`` and the pipeline script) imports it.
"""
