"""offerlake: listing-market analytics as lazy Spark DataFrame operators.

Layers (all functions take and return DataFrames; no global session):

* ``offerlake.functions``  native Column expressions for cleaning and bucketing
* ``offerlake.sources``    table scans, landing CSV snapshots, derived listings
* ``offerlake.operators``  HTML extraction, validation/quality, dedup, aggregation
* ``offerlake.plans``      Bronze -> Silver -> Gold plans, sinks and catalog helpers
* ``offerlake.streaming``  incremental file-arrival ingestion
"""

__version__ = "0.1.0"
