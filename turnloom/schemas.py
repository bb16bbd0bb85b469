"""Schemas of the tables at stage boundaries."""

from pyspark.sql import types as T

CHUNK = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("chunk_id", T.IntegerType()), T.StructField("chunk", T.StringType()), T.StructField("n_tokens", T.IntegerType())])

#: Dialogue lines, the central fact table.
LINE = T.StructType(
    [
        T.StructField("chunk_id", T.LongType()),
        T.StructField("dialogue_index", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("dialogue", T.StringType()),
        T.StructField("chunk_text", T.StringType()),
    ]
)

LEGACY_LINE = T.StructType([T.StructField("role", T.StringType()), T.StructField("dialogue", T.StringType())])

MESSAGE = T.StructType([T.StructField("from", T.StringType()), T.StructField("value", T.StringType())])

#: Nested training samples.
SAMPLE = T.StructType([T.StructField("id", T.StringType()), T.StructField("system", T.StringType()), T.StructField("conversations", T.ArrayType(MESSAGE))])

REPLY = T.StructType([T.StructField("chunk_id", T.LongType()), T.StructField("response", T.StringType()), T.StructField("error", T.StringType())])

REGISTRY = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("formatting", T.StringType()),
        T.StructField("columns", T.MapType(T.StringType(), T.StringType())),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    ]
)

STEP = T.StructType([T.StructField("run_name", T.StringType()), T.StructField("step", T.StringType()), T.StructField("done_at", T.TimestampType())])
