"""Sources and sinks: CSV scan (S1), table sink (K1), vector-free persist (K2),
metrics sink (K4).  Model persistence (K3) lives in ``operators.modeling``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import scratch_path

try:  # MLlib is optional for the pure-SQL parts
    from pyspark.ml.linalg import VectorUDT
except Exception:  # pragma: no cover
    VectorUDT = None  # type: ignore[assignment]


# Fixed values (reference behaviour): the CSV dialect -- header row, '"' as quote
# and as escape (doubled-quote convention), one record per line.
CSV_QUOTE = '"'
CSV_ESCAPE = '"'


def string_schema(columns: Sequence[str]) -> T.StructType:
    """All-string schema: the raw contract, nothing inferred."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV scan with a header, every column a string (no inference pass).

    With ``columns`` the schema is declared up front (no header sniffing on the
    driver); short rows are NULL-padded and long rows truncated (permissive mode).
    ``multi_line`` reads quoted fields that contain line breaks; it makes every
    file one split, so keep it off for large line-oriented inputs.
    """
    reader = spark.read.option("header", "true").option("inferSchema", "false")
    reader = reader.option("quote", CSV_QUOTE).option("escape", CSV_ESCAPE)
    reader = reader.option("multiLine", "true" if multi_line else "false")
    reader = reader.option("mode", "PERMISSIVE")
    if columns is not None:
        reader = reader.schema(string_schema(columns))
    return reader.csv(path)


#: What ``read_csv_checked`` tells of a record that does not fit.
REJECT_COLUMNS = ("raw", "n_fields", "reason", "file")


def read_csv_checked(spark: SparkSession, path: str, columns: Sequence[str], header: bool = True) -> tuple[DataFrame, DataFrame]:
    """S1 with a quarantine: (records that have exactly the declared fields, the others).

    The file is scanned once and stored; nothing is padded or truncated silently.  A record
    that does not fit is a row of the second table: its raw line, the number of its fields
    (separators outside quotes, plus one), the reason (``short``, ``long``, or ``malformed`` where the
    number is right but the quoting is not) and its file.  Line-oriented, as ``read_csv``."""
    schema = string_schema(columns).add("_raw", T.StringType())
    reader = spark.read.option("header", "true" if header else "false").option("quote", CSV_QUOTE).option("escape", CSV_ESCAPE)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_raw")
    stored = materialize(reader.schema(schema).csv(path).withColumn("_file", F.input_file_name()), "csv-checked")
    fits = stored.where(F.col("_raw").isNull()).drop("_raw", "_file")
    unquoted = F.regexp_replace("_raw", '"(?:[^"]|"")*+"', "")
    n_fields = F.regexp_count(unquoted, F.lit(",")) + 1
    reason = F.when(F.col("n_fields") < len(columns), "short").when(F.col("n_fields") > len(columns), "long").otherwise("malformed")
    others = stored.where(F.col("_raw").isNotNull()).select(F.col("_raw").alias("raw"), n_fields.alias("n_fields"), F.col("_file").alias("file"))
    return fits, others.withColumn("reason", reason).select(*REJECT_COLUMNS)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Generic source: parquet by default (vectorised, predicate/column pushdown)."""
    return spark.read.format(fmt).options(**options).load(path)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as parquet under the cluster's shared checkpoint folder and
    read it back.

    Cuts the lineage (a lost executor never forces the upstream shuffles to be
    recomputed) and lets every later consumer -- scalar subqueries, union
    branches, model fits -- scan a columnar table with pruning instead of
    re-running the plan that produced it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def save_table(
    df: DataFrame,
    path: str,
    fmt: str = "csv",
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    only_touched: bool = False,
) -> None:
    """K1: write any format with a save mode; CSV gets a header and keeps the
    quoting dialect of ``read_csv`` and surrounding whitespace of values.

    With ``only_touched`` an overwrite replaces the partitions (say, the months) that ``df``
    has rows of and leaves all others as they are, so a batch can be written again."""
    writer = df.write.format(fmt).mode(mode)
    if only_touched:
        if not partition_by or mode != "overwrite":
            raise ValueError("only_touched is an overwrite of partitions")
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = (
            writer.option("header", "true")
            .option("quote", CSV_QUOTE)
            .option("escape", CSV_ESCAPE)
            .option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false")
        )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def land_csv(
    spark: SparkSession,
    csv_path: str,
    out_path: str,
    columns: Sequence[str] | None = None,
    multi_line: bool = False,
    partition_by: Sequence[str] | None = None,
) -> DataFrame:
    """S1 + K1: scan the raw CSV once (all strings) and land it as parquet.

    CSV scans are not vectorised and cannot prune columns; every later stage
    reads the landed columnar copy instead (pushdown, pruning, and partition
    pruning when ``partition_by`` is given)."""
    save_table(read_csv(spark, csv_path, columns, multi_line), out_path, fmt="parquet", partition_by=partition_by)
    return spark.read.parquet(out_path)


def vector_columns(df: DataFrame) -> list[str]:
    if VectorUDT is None:
        return []
    return [f.name for f in df.schema.fields if isinstance(f.dataType, VectorUDT)]


def drop_vector_columns(df: DataFrame) -> DataFrame:
    """K2: drop ``VectorUDT`` columns (CSV cannot hold them) before persisting."""
    cols = vector_columns(df)
    return df.drop(*cols) if cols else df


def save_metrics(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4: one CSV row per model, header, no index.  The table has one row per
    model, so a single output file is bounded by construction."""
    save_table(metrics.coalesce(1), path, fmt="csv", mode=mode)
