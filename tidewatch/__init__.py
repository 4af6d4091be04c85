"""tidewatch — time-series anomaly detection as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame``.  Series are
identified by a list of key columns and ordered by a time column plus an
optional tie-break column.  Long series are never handled whole by one task:
sequential operators run over fixed-size row blocks (see
``tidewatch.operators.sequence``).
"""

__version__ = "0.1.0"
