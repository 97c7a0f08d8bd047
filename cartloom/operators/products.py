"""Product features: imputation, unit vectors, family and section statistics."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.functions.vectors import with_unit_vector


def product_universe(*splits: DataFrame) -> DataFrame:
    """Distinct products over all given splits."""
    keys = splits[0].select("partnumber")
    for split in splits[1:]:
        keys = keys.union(split.select("partnumber"))
    return keys.distinct()


def restrict_products(products: DataFrame, universe: DataFrame) -> DataFrame:
    return products.join(universe.select("partnumber"), "partnumber", "left_semi")


def mean_vectors(products: DataFrame, key: str = "family", vec: str = "embedding") -> DataFrame:
    """Element-wise mean vector per key over the rows that have one (running sums per task)."""
    present = products.filter(F.col(vec).isNotNull() & (F.size(vec) > 0))
    means = present.groupBy(key).agg(
        Summarizer.mean(array_to_vector(F.col(vec).cast("array<double>"))).alias("_mean")
    )
    return means.select(key, vector_to_array("_mean").alias("mean_embedding"))


def impute_embeddings(products: DataFrame) -> DataFrame:
    """Null embedding <- mean of the family; still null <- mean over all embeddings so far filled."""
    means = mean_vectors(products).filter(F.col("family").isNotNull())
    # After the family step a family with a mean holds: its own vectors, and the mean for its nulls.
    # The mean over all rows is therefore the family means weighted by family size, plus the
    # vectors of rows without a family.
    sizes = products.filter(F.col("family").isNotNull()).groupBy("family").agg(
        F.count(F.lit(1)).cast("double").alias("_weight")
    )
    loose = products.filter(F.col("family").isNull() & F.col("embedding").isNotNull()).select(
        F.col("embedding").cast("array<double>").alias("mean_embedding"), F.lit(1.0).alias("_weight")
    )
    weighted = means.join(sizes, "family").select("mean_embedding", "_weight").unionByName(loose)
    overall = weighted.agg(
        Summarizer.mean(array_to_vector("mean_embedding"), F.col("_weight")).alias("_mean")
    ).select(vector_to_array("_mean").alias("_mean")).scalar()
    # Only rows without a vector meet the means; the others are passed through without a shuffle.
    vector = F.col("embedding").cast("array<double>")
    present = products.filter(F.col("embedding").isNotNull()).withColumn("embedding", vector)
    missing = (
        products.filter(F.col("embedding").isNull()).drop("embedding").join(means, "family", "left")
        .withColumn("embedding", F.coalesce("mean_embedding", overall)).drop("mean_embedding")
    )
    return present.unionByName(missing)


def impute_section(products: DataFrame) -> DataFrame:
    """Null `cod_section` <- most frequent section of the family; the smallest on a tie."""
    modes = products.filter(F.col("family").isNotNull()).groupBy("family").agg(
        F.mode("cod_section", True).alias("_section")
    )
    return (
        products.join(modes, "family", "left")
        .withColumn("cod_section", F.coalesce("cod_section", "_section"))
        .drop("_section")
    )


def normalize_embedding(products: DataFrame) -> DataFrame:
    return with_unit_vector(products, "embedding")


def product_statistics(products: DataFrame) -> DataFrame:
    """Colour count, discount rate and number of colours per family; discount rate per section.

    Null family or section is a group of its own, and null counts as a colour value.
    """
    family = products.groupBy(F.col("family").alias("_family")).agg(
        F.count("color_id").alias("color_family_frequency"),
        F.avg("discount").alias("family_discount_rate"),
        (F.count_distinct("color_id") + F.max(F.col("color_id").isNull().cast("int"))).alias(
            "family_unique_colors"
        ),
    )
    section = products.groupBy(F.col("cod_section").alias("_section")).agg(
        F.avg("discount").alias("section_discount_rate")
    )
    return (
        products.join(family, F.col("family").eqNullSafe(F.col("_family")), "left")
        .join(section, F.col("cod_section").eqNullSafe(F.col("_section")), "left")
        .drop("_family", "_section")
    )


def product_features(products: DataFrame) -> DataFrame:
    """All product columns of the model; the embedding is kept as a unit vector."""
    return product_statistics(normalize_embedding(products))

