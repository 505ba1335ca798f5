"""tallyspark: load periodic metric reports with Spark.

``plans.load.load_files`` / ``load_reports`` run the whole load;
``sinks.tables`` writes the result; ``streaming.reports`` runs it per batch
of arriving files. See README.md for the plan shape at scale.
"""

__version__ = "0.1.0"
