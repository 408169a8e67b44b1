"""Declared schemas. Nothing is inferred: stored tables are conformed to these before use."""

from pyspark.sql import types as T

_S, _D, _TS, _B, _I, _L = (
    T.StringType(), T.DateType(), T.TimestampType(), T.BooleanType(), T.IntegerType(), T.LongType(),
)
PRICE = T.DecimalType(18, 6)
CURVE_PRICE = T.DecimalType(18, 4)
FACTOR = T.DecimalType(20, 10)


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


PAGE = _schema(
    ("source", _S), ("request_id", _S), ("page_no", _I), ("route", _S),
    ("params", T.MapType(_S, _S)), ("retrieved_at", _TS), ("sha256", _S), ("body", _S),
)
REQUEST = _schema(
    ("request_id", _S), ("series_ids", T.ArrayType(_S)), ("start", _D), ("end", _D),
)
OBSERVATION_KEY = ["source", "series_id", "observation_date"]
SILVER = _schema(
    ("source", _S), ("series_id", _S), ("observation_date", _D), ("price", PRICE), ("unit", _S),
    ("non_positive", _B), ("retrieved_at", _TS), ("logical_input_id", _S),
    ("raw_artifact_key", _S),
)
REJECTED = _schema(("source", _S), ("raw_artifact_key", _S), ("row_json", _S), ("reason", _S))
# `retrieved_at` is the retrieval that established the current price; `last_seen_at` is the latest
# retrieval that has seen the observation, changed or not, and is what orders retrievals.
GOLD = T.StructType([*SILVER.fields, T.StructField("last_seen_at", _TS, True)])
REVISION = T.StructType([
    *GOLD.fields,
    T.StructField("superseded_at_version", _L, True),
    T.StructField("superseded_by_logical_input_id", _S, True),
])
REVISION_KEY = [*OBSERVATION_KEY, "superseded_at_version"]
PARAMS = _schema(("position", _S), ("month", T.ByteType()), ("s", FACTOR), ("n_obs", _L))
EXCLUDED = _schema(("observation_date", _D), ("position", _S), ("reason", _S))
CURVE_KEY = ["curve_id", "as_of_date", "position"]
CURVE = _schema(
    ("curve_id", _S), ("kind", _S), ("as_of_date", _D), ("position", _S), ("price", CURVE_PRICE),
    ("status", _S), ("gap_reason", _S), ("estimate_type", _S), ("shape_source", _S),
    ("method_version", _S), ("shape_method_version", _S), ("params_sha256", _S),
)
MONITORED = _schema(
    ("dataset_version", _L), ("curve_id", _S), ("position", _S), ("as_of_date", _D),
    ("price", CURVE_PRICE), ("status", _S),
)
#: A value that rose over the last priced one of its position.
STEP = _schema(
    ("curve_id", _S), ("position", _S), ("dataset_version", _L), ("as_of", _D), ("price", CURVE_PRICE),
    ("previous_price", CURVE_PRICE), ("previous_version", _L),
)
#: What `crossings` finds.
CROSSING = _schema(
    ("alert_id", _S), ("rule_id", _S), ("dataset_version", _L), ("curve_id", _S), ("position", _S),
    ("as_of", _D), ("price", CURVE_PRICE), ("previous_price", CURVE_PRICE), ("threshold", CURVE_PRICE),
    ("created_at", _TS),
)
DATASET_VERSION = _schema(
    ("dataset_version", _L), ("logical_input_id", _S), ("manifest_sha256", _S), ("source", _S),
    ("created_at", _TS), ("imported_at", _TS), ("observations", _L), ("revisions", _L),
    ("curve_points", _L), ("price_changes", _L),
)
ATTEMPT = _schema(
    ("attempt_id", _S), ("logical_input_id", _S), ("status", _S), ("dataset_version", _L),
    ("quality", _S), ("merge", _S), ("error", _S), ("duration_s", T.DoubleType()),
    ("finished_at", _TS),
)
OUTBOX = _schema(
    ("event_id", _S), ("event_type", _S), ("dataset_version", _L), ("payload", _S),
    ("status", _S), ("attempts", _I), ("next_attempt_at", _TS), ("last_error", _S),
    ("created_at", _TS), ("processed_at", _TS),
)
RULE = _schema(
    ("rule_id", _S), ("curve_id", _S), ("position", _S), ("threshold", CURVE_PRICE),
    ("created_at", _TS), ("deleted_at", _TS), ("baseline_version", _L), ("armed", _B),
    ("last_value", CURVE_PRICE), ("last_as_of", _D), ("last_version", _L),
)
FIRED = _schema(
    ("seq", _L), ("alert_id", _S), ("rule_id", _S), ("dataset_version", _L), ("curve_id", _S),
    ("position", _S), ("as_of", _D), ("price", CURVE_PRICE), ("previous_price", CURVE_PRICE),
    ("threshold", CURVE_PRICE), ("fired_at", _TS),
)
LOAD_LOG = _schema(
    ("table_name", _S), ("source_id", _S), ("row_count", _L), ("sha256", _S), ("loaded_at", _TS),
)


def conform(df, schema: T.StructType):
    """Bring a stored table to `schema`: exact columns, order and types, matched by name.

    Gold written before `last_seen_at` existed lacks the column; its best watermark is
    `retrieved_at`.
    """
    from pyspark.sql import functions as F

    names = {f.name for f in schema.fields}
    if "last_seen_at" in names and "last_seen_at" not in df.columns:
        df = df.withColumn("last_seen_at", F.col("retrieved_at"))
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def empty(spark, schema: T.StructType):
    return spark.createDataFrame([], schema)
