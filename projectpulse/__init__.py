"""projectpulse — Spark-native operators for project-delivery KPIs and risk scoring.

Every public operator takes DataFrames and returns a DataFrame; only small fitted
scalars (category lists, medians, means, coefficients) ever come to the driver.
"""

__version__ = "0.1.0"
