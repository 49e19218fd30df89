"""recordsync: Spark-native record synchronisation and change analytics.

Every operator is a lazy DataFrame -> DataFrame function built from Spark SQL
built-ins (no Python UDFs), so Catalyst can prune, push down and plan the
shuffles.  Sub-packages:

* ``sources``   – readers for driver/ERP tables, JSON queues, JDBC; stand-in tables
* ``functions`` – Column-level normalisers (text, tax id, flags, nested fields)
* ``operators`` – set differences, fingerprints, joins, aggregates, merges,
                  validation/quarantine, payload builders
* ``plans``     – composite views (client master, change sets) and the query catalog
* ``streaming`` – Structured Streaming ingestion with foreachBatch merges
"""

__all__ = ["session"]
