"""inboxlens: campaign-event analytics expressed as Spark DataFrame plans.

Layers
------
sources/    readers and option builders (files, JDBC, Kafka) and the adapter that
            maps the generated test tables onto the campaign-event shape
functions/  Column-expression helpers (exact rates, user-agent rules, contract checks)
operators/  pure ``DataFrame -> DataFrame`` transformations: decode, silver
            aggregates, gold queries, joins, sessions, routing, dimensions
streaming/  Structured Streaming jobs: landing, changelog sinks, compaction, fan-out
plans/      the named query catalogue and its SQL oracle

Transformations never perform I/O or collect; the same silver function serves a
batch DataFrame and a streaming one.
"""

__version__ = "0.1.0"
