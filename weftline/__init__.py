"""Weftline: a PySpark-native engine for paired-end sequencing tables.

Subpackages: ``sources`` (readers, sinks, adapters), ``functions`` (column
expressions), ``operators`` (joins, aggregations, clustering, alignment),
``plans`` (end-to-end jobs and the query registry), ``streaming``.
"""

__version__ = "0.1.0"
