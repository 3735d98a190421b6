"""cropwire: Spark-native ingestion of daily climate and weekly commodity-price documents.

Every operator is a plain ``DataFrame -> DataFrame`` function built from Spark's
own functions; the cycle plans in :mod:`cropwire.plans` wire them together and
the same functions run inside Structured Streaming ``foreachBatch``.
"""

__all__ = ["schemas", "functions", "sources", "operators", "plans", "streaming"]
