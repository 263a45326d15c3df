"""kiln: text-corpus building, cleaning and classification on Spark.

Every operator takes and returns DataFrames; row data stays on the executors.
"""

__version__ = "0.1.0"
