"""Fixed table schemas: given to readers, and to reports by ``conform``."""

from pyspark.sql import types as T

CHUNK_METADATA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("chunk_id", T.IntegerType()),
])

TRAIN_SAMPLES = T.StructType([
    T.StructField("input_ids", T.ArrayType(T.LongType())),
    T.StructField("labels", T.ArrayType(T.LongType())),
    T.StructField("attention_mask", T.ArrayType(T.LongType())),
])

# One element of the JSON array written next to a vector store.
METADATA_RECORD = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])

BENCHMARK_REPORT = T.StructType([
    T.StructField("question", T.StringType()),
    T.StructField("k", T.IntegerType()),
    T.StructField("rerank", T.BooleanType()),
    T.StructField("answer", T.StringType()),
    T.StructField("total_time", T.DoubleType()),
    T.StructField("retrieval_time", T.DoubleType()),
    T.StructField("generation_time", T.DoubleType()),
    T.StructField("time_per_token", T.DoubleType()),
])

COMPARISON_REPORT = T.StructType([
    T.StructField("question", T.StringType()),
    T.StructField("rag_answer", T.StringType()),
    T.StructField("ft_answer", T.StringType()),
    T.StructField("rag_time", T.DoubleType()),
    T.StructField("ft_time", T.DoubleType()),
    T.StructField("time_difference", T.DoubleType()),
    T.StructField("rag_time_per_token", T.DoubleType()),
    T.StructField("ft_time_per_token", T.DoubleType()),
])


def conform(df, schema: T.StructType):
    """Select and cast ``df`` to a fixed schema (column order and types)."""
    from pyspark.sql import functions as F
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
