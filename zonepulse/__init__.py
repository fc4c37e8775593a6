"""zonepulse: trip-demand analytics as plain Spark DataFrame operators.

Layers (each a ``DataFrame -> DataFrame`` function, composed with
``DataFrame.transform``):

* ``zonepulse.sources``   – scans, fixture adapters, writers.
* ``zonepulse.functions`` – column-level helpers (calendar labels, safe
  arithmetic, in-plan quantile thresholds).
* ``zonepulse.operators`` – cleaning, demand aggregates, zone features,
  clustering, insights, profiling.
* ``zonepulse.plans``     – the medallion pipeline, join strategy helpers
  and the query registry used by ``__spark_entry__``.
* ``zonepulse.streaming`` – Structured Streaming demand alerts.
"""

__version__ = "0.1.0"
