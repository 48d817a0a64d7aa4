"""rankflow: product-ranking snapshot analytics on Spark.

Every operator takes and returns a ``DataFrame`` (or a ``Column`` for scalar
functions), so jobs compose with ``df.transform(op, ...)`` and Catalyst sees
one declarative plan end to end.

Layout:
    rankflow.schemas            fixed StructTypes, column/category normalisation
    rankflow.session            session defaults, shared scratch/checkpoint paths
    rankflow.sources            CSV/Parquet scans and sinks, nested JSON, HTML pages
    rankflow.functions          scalar Column functions (text, unit numbers, metrics)
    rankflow.operators          relational, aggregate, window, feature and model operators
    rankflow.plans              end-to-end jobs and the driver-table query catalogue
    rankflow.streaming          incremental snapshot ingest (Structured Streaming)
"""

__version__ = "0.1.0"
