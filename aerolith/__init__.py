"""Spark-native weather analytics: medallion layers, star schema, serving, ML data work.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from Spark SQL
expressions; nothing is collected to the driver inside an operator.
"""

__all__ = ["session", "profiles", "constants"]
