"""wattflow — energy-data medallion analytics as composable PySpark DataFrame operators.

Layers: ``sources`` (scans), ``functions`` (column expressions), ``operators``
(DataFrame -> DataFrame transforms: silver, staging, dimensions, facts, data
checks, reports, snapshots), ``sinks`` (observed writes, tables), ``plans``
(end-to-end builds and the registered query catalogue), ``streaming``
(incremental bronze -> silver with Structured Streaming).
"""

__version__ = "0.1.0"
