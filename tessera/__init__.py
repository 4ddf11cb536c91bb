"""tessera: a Spark-native corpus and retrieval engine.

Every operator is a DataFrame-in, DataFrame-out function built on Spark SQL
expressions, Arrow batch functions (``mapInPandas`` / ``pandas_udf``), Spark ML
and Structured Streaming.  Models (tokenizer, embedder, generator, scorer) are
plug-ins given as factories; built-in defaults keep every job runnable and
checkable without model weights.
"""

__version__ = "0.1.0"
