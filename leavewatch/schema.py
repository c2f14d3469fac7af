"""Schema of the raw event log: one row per user interaction."""

from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType([
    T.StructField("artist", T.StringType()),
    T.StructField("auth", T.StringType()),
    T.StructField("firstName", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("itemInSession", T.LongType()),
    T.StructField("lastName", T.StringType()),
    T.StructField("length", T.DoubleType()),
    T.StructField("level", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("page", T.StringType()),
    T.StructField("registration", T.LongType()),
    T.StructField("sessionId", T.LongType()),
    T.StructField("song", T.StringType()),
    T.StructField("status", T.LongType()),
    T.StructField("ts", T.LongType()),
    T.StructField("userAgent", T.StringType()),
    T.StructField("userId", T.StringType()),
])
