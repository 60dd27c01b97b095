"""matchlake: nested match documents -> relational star -> marts, on Spark.

Everything is a DataFrame transformation built from built-in Spark
expressions; see README.md for the module map.
"""

__version__ = "0.1.0"
