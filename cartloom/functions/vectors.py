"""Vector steps on array columns, done by Spark ML inside the JVM."""

from __future__ import annotations

from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_unit_vector(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """`column` scaled to length 1 as array<double>; a zero vector stays zero, null stays null."""
    out = out or column
    filled = df.withColumn("_raw", F.coalesce(F.col(column), F.array().cast("array<double>")))
    scaled = Normalizer(p=2.0, inputCol="_vec", outputCol="_unit").transform(
        filled.withColumn("_vec", array_to_vector("_raw"))
    )
    unit = F.when(F.col(column).isNotNull(), vector_to_array("_unit"))
    return scaled.withColumn(out, unit).drop("_raw", "_vec", "_unit")
