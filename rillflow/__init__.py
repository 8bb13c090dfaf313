"""rillflow: record-moving and summarising jobs as plain PySpark functions.

Every operator takes and returns DataFrames, batch or streaming, so Spark plans the whole job:

* ``sources``   literal rows, text lines, zipped text, dated paths, JDBC queries, message logs
* ``functions`` column expressions: delimited text, JSON records, output formats
* ``operators`` filters, routing, tokenising, counting, grouping, co-grouping, union, caps, taps
* ``sinks``     text, message logs, document stores, replay-safe table batches
* ``streaming`` bounded reads, query life cycle, fan-out
* ``plans``     complete jobs built from the above, and the check queries with their SQL oracles
"""
