"""tidemark: Spark-native operators for the data side of a classification model in production.

Every operator takes and returns Spark DataFrames; nothing is collected to the driver except
bounded summaries (split points, one-row statistics).
"""

__version__ = "0.1.0"
