"""Column types of the three input tables and of the raw user records."""

from pyspark.sql import types as T

INTERACTIONS = T.StructType([
    T.StructField("session_id", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("timestamp_local", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("country", T.ShortType()),
    T.StructField("partnumber", T.IntegerType()),
    T.StructField("device_type", T.ShortType()),
    T.StructField("pagetype", T.ShortType()),
    T.StructField("add_to_cart", T.ByteType()),
])

INTERACTIONS_TEST = T.StructType([f for f in INTERACTIONS.fields if f.name != "add_to_cart"])

USERS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("country", T.ShortType()),
    T.StructField("R", T.IntegerType()),
    T.StructField("F", T.IntegerType()),
    T.StructField("M", T.DoubleType()),
])

PRODUCTS = T.StructType([
    T.StructField("partnumber", T.IntegerType()),
    T.StructField("family", T.IntegerType()),
    T.StructField("color_id", T.IntegerType()),
    T.StructField("cod_section", T.ShortType()),
    T.StructField("discount", T.ByteType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])

RAW_USER = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("values", T.StructType([
        T.StructField("country", T.ArrayType(T.IntegerType())),
        T.StructField("R", T.ArrayType(T.IntegerType())),
        T.StructField("F", T.ArrayType(T.IntegerType())),
        T.StructField("M", T.ArrayType(T.DoubleType())),
    ])),
])
