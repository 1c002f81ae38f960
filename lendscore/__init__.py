"""lendscore: a Spark-native tabular binary-classification toolkit.

Every operator takes and returns Spark DataFrames (or fits Spark ML
stages); only model parameters, small dictionaries and metrics ever
reach the driver.
"""

__version__ = "0.1.0"
