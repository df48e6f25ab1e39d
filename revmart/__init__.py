"""revmart: payment-revenue warehouse jobs on Spark DataFrames.

Layers: ``sources`` (scans and fixture tables), ``operators`` (reusable,
column-parameterised transforms), ``functions`` (Column expressions),
``sinks`` (crash-safe table writes), ``plans`` (the warehouse models and
the warehouse run), ``streaming`` (Structured Streaming ingest).
"""

__all__ = ["session"]
