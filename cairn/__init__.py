"""cairn: Spark-native data-modeling and analytics operators.

Every operator is a pure function from DataFrames to a DataFrame built from
Spark's own expressions; see ``cairn.operators``.
"""

__version__ = "0.1.0"
