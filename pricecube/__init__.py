"""pricecube: half-yearly price analytics expressed as Spark DataFrame plans.

Layers
------
functions/   column-expression helpers (rounding parity, tiers, periods)
sources/     hypercube decoding, dataset union/filters, CSV, catalog
operators/   staging, annual mart, data quality, serving queries, publishing
plans/       fixture views over the driver tables, query registry, oracle SQL
streaming/   incremental landing of cube documents with Structured Streaming
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
