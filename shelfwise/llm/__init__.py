"""Training-data pipeline operators: dedup, filters, fingerprints, sharding, packing.

Nothing else in the library imports this subpackage.
"""
