"""gridlake: hourly weather x electricity-load analytics as Spark DataFrame jobs.

Every public function is a ``DataFrame -> DataFrame`` transformation (or a
thin I/O step around ``spark.read`` / ``df.write`` / ``readStream``), so the
same code runs on ``local[*]`` and on a cluster.
"""

__version__ = "0.1.0"
