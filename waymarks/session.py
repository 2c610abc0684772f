"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The JVM never compiles a method above 8000 bytes of bytecode.  Spark's default accepts
# generated methods far above that, which then run interpreted; this makes it split them.
SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}
UNSET = "65535"


def tuned(spark: SparkSession) -> SparkSession:
    """Apply the settings that the session still has at their defaults."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, UNSET) == UNSET:
            spark.conf.set(key, value)
    return spark
