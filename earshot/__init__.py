"""earshot — listening-event analytics on Spark.

Plain functions DataFrame -> DataFrame. I/O lives only in ``sources``,
``sinks``, ``streaming`` and ``plans``.
"""

__version__ = "0.1.0"
