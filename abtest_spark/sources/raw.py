"""Raw clickstream sources.

``read_raw`` is the production source: a headed CSV read by column name with a
declared schema (no inference pass over the data). ``raw_from_events`` derives the same
six-column raw stream from the driver's ``events`` table with integer rules,
injecting the junk the quality checks must find (bad and missing timestamps,
missing and malformed experiments, exact duplicate rows).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abtest_spark.schema import RAW_COLUMNS, RAW_SCHEMA


def _header(spark: SparkSession, path: str, schema, **options) -> list[str]:
    """Column names of the files' header (first line only, no pass over the data)."""
    names = spark.read.options(header=True, inferSchema=False, **options).csv(path).columns
    missing = [c for c in schema.names if c not in names]
    if missing:
        raise ValueError(f"{path}: the header lacks {', '.join(missing)}")
    return names


def _typed(text: DataFrame, schema) -> DataFrame:
    """Declared columns by name; a value that does not fit its type becomes NULL."""
    return text.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])


def _text_reader(reader, names: list[str], options: dict):
    # With enforceSchema off every file's header is held against these names,
    # so a file whose columns stand in another order fails instead of shifting.
    text = T.StructType([T.StructField(c, T.StringType()) for c in names])
    return reader.schema(text).options(header=True, enforceSchema=False, **options)


def read_raw_text(spark: SparkSession, path: str, schema=RAW_SCHEMA, **options) -> DataFrame:
    """Headed CSV as text, columns by the header's names (extra ones included)."""
    return _text_reader(spark.read, _header(spark, path, schema, **options), options).csv(path)


def read_raw(spark: SparkSession, path: str, schema=RAW_SCHEMA, **options) -> DataFrame:
    """Headed CSV with typed columns, bound by header name; ``timestamp`` kept as text.

    Columns may stand in any order and extra ones are ignored; a missing column
    raises, and so does a file whose header differs from the first one's. Values
    that do not fit the declared type become NULL and are counted by
    ``bad_values``; pass a schema with string ids to keep textual ids.
    """
    return _typed(read_raw_text(spark, path, schema, **options), schema)


def bad_values(text: DataFrame, schema=RAW_SCHEMA) -> DataFrame:
    """(column, n): values of ``read_raw_text`` that do not fit the declared type."""
    counts = text.agg(
        *[
            F.count_if(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull()).alias(f.name)
            for f in schema.fields
        ]
    )
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in schema.names]
    return counts.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.column", "_p.n")


def read_raw_stream(spark: SparkSession, path: str, schema=RAW_SCHEMA, **options) -> DataFrame:
    """The same as a stream over arriving files; the header is taken from the files there at the start.

    With none yet, files must hold the declared columns in the declared order.
    """
    try:
        names = _header(spark, path, schema)
    except AnalysisException:  # no file yet
        names = schema.names
    return _typed(_text_reader(spark.readStream, names, options).csv(path), schema)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_from_events(events: DataFrame, buy_min_value: float = 80.0) -> DataFrame:
    """Map ``events(event_id, ts, user_id, event_type, value, props)`` to raw.

    Rules (integer arithmetic, identical in any SQL engine):
      timestamp   'not-a-time' if event_id % 101 = 0, NULL if % 103 = 0, else ts as text
      event_name  'BUY' for purchases with value > buy_min_value (80), else upper(event_type)
      item_id     event_id % 500
      site        'MLA' for even users, else 'MLB'
      experiments NULL if event_id % 97 = 0, '{}' if % 89 = 0, '{malformed}' if % 83 = 0,
                  else two multi-variant experiments and one single-variant one
      duplicates  rows with event_id % 50 = 0 appear twice
    """
    eid = F.col("event_id")
    uid = F.col("user_id")
    ts_text = (
        F.when(eid % 101 == 0, F.lit("not-a-time"))
        .when(eid % 103 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("ts").cast("string"))
    )
    event_name = (
        F.when((F.col("event_type") == "purchase") & (F.col("value") > F.lit(float(buy_min_value))), F.lit("BUY"))
        .otherwise(F.upper(F.col("event_type")))
    )
    experiments = (
        F.when(eid % 97 == 0, F.lit(None).cast("string"))
        .when(eid % 89 == 0, F.lit("{}"))
        .when(eid % 83 == 0, F.lit("{malformed}"))
        .otherwise(
            F.concat(
                F.lit("{checkout/button="),
                (uid % 2 + 1).cast("string"),
                F.lit(", search/ranking="),
                (uid % 3 + 1).cast("string"),
                F.lit(", legacy/solo=1}"),
            )
        )
    )
    base = events.select(
        eid.alias("event_id"),
        uid.alias("user_id"),
        ts_text.alias("timestamp"),
        event_name.alias("event_name"),
        (eid % 500).alias("item_id"),
        F.when(uid % 2 == 0, F.lit("MLA")).otherwise(F.lit("MLB")).alias("site"),
        experiments.alias("experiments"),
    )
    # Duplicates: one extra copy of every 50th event. Expressed as a generator
    # (one or two output rows per input row) so the source is scanned once.
    copies = F.when(eid % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return base.withColumn("_copy", F.explode(copies)).select(*RAW_COLUMNS)


def load_raw(spark: SparkSession, sf_dir: str, buy_min_value: float = 80.0) -> DataFrame:
    """Raw stream derived from ``{sf_dir}/events.parquet``. With
    ``buy_min_value=0`` every purchase is a BUY (the uncut marker)."""
    return raw_from_events(read_table(spark, sf_dir, "events"), buy_min_value)
