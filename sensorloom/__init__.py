"""sensorloom: data operators for sensor, event and log streams on Apache Spark.

Every operator takes and returns a DataFrame. The sub-packages are

* ``sources`` and ``sinks``: topics, files, tables, model stores
* ``functions``: column expressions (parsing, time, levels, units)
* ``operators``: quality, aggregation, profiling, ordered series, detectors,
  evaluation, time-series and log exploration
* ``streaming``: Structured Streaming drivers and keyed-state twins
* ``plans``: the query catalogue with one SQL statement per query
"""
