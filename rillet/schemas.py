"""Schemas of the engine's inputs and outputs (fixed, never inferred)."""

from pyspark.sql import types as T

# JSON message shapes of the reference's streams.
SIGNAL = T.StructType([
    T.StructField("createTime", T.StringType()),
    T.StructField("baselineId", T.IntegerType()),
    T.StructField("signalValue", T.FloatType()),
])

PAYMENT = T.StructType([
    T.StructField("createTime", T.StringType()),
    T.StructField("orderId", T.LongType()),
    T.StructField("payAmount", T.DoubleType()),
    T.StructField("payPlatform", T.IntegerType()),
    T.StructField("teamId", T.IntegerType()),
])

BITS = T.StructType([
    T.StructField("createTime", T.StringType()),
    T.StructField("binaryInt", T.IntegerType()),
])

LINES = T.StructType([T.StructField("line", T.StringType())])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

# Outputs.
WORD_COUNT = T.StructType([
    T.StructField("word", T.StringType()),
    T.StructField("count", T.LongType()),
])

CHANGE_OPS = ("+I", "-U", "+U", "-D")
