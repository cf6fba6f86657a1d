"""Fixed schemas of the tables the operators exchange."""

from pyspark.sql import types as T

CORPUS = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("text", T.StringType()),
])

CHANGE_LOG = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("op", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("text", T.StringType()),
])

REQUESTS = T.StructType([
    T.StructField("req_id", T.LongType()),
    T.StructField("request", T.StringType()),
])

POSTINGS = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("word", T.StringType()),
])

# Operation names of the change log (fixed values).
ADD, REINDEX, REMOVE, CLEAR = "ADD", "REINDEX", "REMOVE", "CLEAR"
