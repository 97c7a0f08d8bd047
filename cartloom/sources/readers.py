"""Reading the three tables, and turning nested user records into rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom import schemas
from cartloom.operators.sampling import first_rows


def load_data(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    *,
    file_type: str = "csv",
    select_cols: Sequence[str] | None = None,
    n_rows: int | None = None,
) -> DataFrame:
    """CSV with a header (typed by `schema`, never inferred) or Parquet; projection and row cap."""
    if file_type == "csv":
        if schema is None:
            raise ValueError("a CSV read needs a schema")
        # Header names are matched to the schema's; CSV columns may come in any order. Whole
        # numbers are read as text first, as columns with gaps are often written as 24.0.
        names = spark.read.option("header", True).csv(path).columns
        kinds = {f.name: f.dataType for f in schema.fields}
        read_as = {
            n: T.StringType() if isinstance(kind, T.IntegralType) else kind for n, kind in kinds.items()
        }
        ordered = T.StructType([T.StructField(n, read_as.get(n, T.StringType())) for n in names])
        df = spark.read.schema(ordered).option("header", True).option("mode", "FAILFAST").csv(path)
        df = df.select(*[
            (_whole(n, kinds[n]) if isinstance(kinds[n], T.IntegralType) else F.col(n)).alias(n) for n in schema.names if n in names
        ])
    elif file_type == "parquet":
        df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    else:
        raise ValueError(f"no reader for {file_type!r} files, only for csv and parquet")
    if select_cols:
        df = df.select(*select_cols)
    return df if n_rows is None else first_rows(df, n_rows)


def _whole(name: str, kind: T.DataType) -> Column:
    """Text as a whole number, exact to 38 digits; a fraction or anything but a number is an error."""
    number = F.trim(F.col(name)).cast("decimal(38,6)")
    wrong = F.concat(F.lit(f"{name} is no whole number: "), F.col(name))
    return F.when(number.isNull() | (number == F.floor(number)), number).otherwise(F.raise_error(wrong)).cast(kind)


def read_products(
    spark: SparkSession, path: str, *, select_cols: Sequence[str] | None = None, n_rows: int | None = None
) -> DataFrame:
    """Products; the misspelt header `familiy` of the raw file is accepted, `select_cols` names it `family`."""
    df = load_data(spark, path, schemas.PRODUCTS, file_type="parquet").withColumnRenamed("familiy", "family")
    if select_cols:
        df = df.select(*select_cols)
    return df if n_rows is None else first_rows(df, n_rows)


def read_user_records(spark: SparkSession, path: str) -> DataFrame:
    """Raw user records, one JSON object per line."""
    return spark.read.schema(schemas.RAW_USER).json(path)


def user_rows(records: DataFrame) -> DataFrame:
    """Nested records -> one row per entry of the parallel lists."""
    entries = F.arrays_zip("values.country", "values.R", "values.F", "values.M")
    return cast_users(
        records.select("user_id", F.posexplode(entries).alias("entry", "_e")).select("user_id", "entry", "_e.*"),
        keep=("entry",),
    )


def recent_user_rows(records: DataFrame) -> DataFrame:
    """The entry with the smallest R of each record, the first one on a tie."""
    recent = F.array_position("values.R", F.array_min("values.R")).cast("int")
    picked = [F.element_at(f"values.{c}", recent).alias(c) for c in ("country", "R", "F", "M")]
    return cast_users(records.filter(F.size("values.R") > 0).select("user_id", *picked))


def merge_batches(spark: SparkSession, folder: str) -> DataFrame:
    """All Parquet batch files of a folder as one table."""
    return cast_users(spark.read.parquet(folder))


def _cast(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(
        *[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns if c in types or c in keep]
    )


def cast_users(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return _cast(df, schemas.USERS, keep)


# Largest number of each narrow column.
NARROW = {
    "session_id": 4294967295, "user_id": 4294967295, "country": 255, "partnumber": 65535,
    "device_type": 255, "pagetype": 255, "add_to_cart": 255,
}


def cast_interactions(df: DataFrame, train: bool = True) -> DataFrame:
    """Fixed column types; a value outside the column's range is an error. Test has no label."""
    schema = schemas.INTERACTIONS if train else schemas.INTERACTIONS_TEST
    checked = df
    for name, top in NARROW.items():
        if name in schema.names and name in df.columns:
            message = F.concat(F.lit(f"{name} out of range: "), F.col(name).cast("string"))
            inside = F.col(name).isNull() | F.col(name).between(0, top)
            checked = checked.withColumn(name, F.when(inside, F.col(name)).otherwise(F.raise_error(message)))
    return _cast(checked, schema, keep=("interaction_id",))
