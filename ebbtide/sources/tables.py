"""Reading and writing tables. Declared schemas first; inference only when none is given."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import no_nan
from ..operators.quality import hash_text, row_hash_sums
from .schemas import AUDIT, TABLES


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path resolves on whatever file system Spark reads it from."""
    try:
        spark.read.format("binaryFile").load(path).select("path").limit(0).collect()
        return True
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return False
        raise


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on whatever file system it lies; nothing happens if it is gone already."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "csv") -> DataFrame:
    """One table. CSV has a header; NaN in double columns becomes NULL; a missing path raises."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "PERMISSIVE")
        reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    elif schema:
        reader = reader.schema(schema)
    df = reader.load(path)
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: no_nan(c) for c in doubles}) if doubles and fmt == "csv" else df


def read_table_set(spark: SparkSession, folder: str, schemas: Mapping[str, T.StructType] = TABLES, fmt: str = "csv",
                   prefix: str = "") -> dict[str, DataFrame]:
    """Several tables; all files must be present before any is read."""
    paths = {n: f"{folder.rstrip('/')}/{prefix}{n}.{fmt}" for n in schemas}
    gone = [p for p in paths.values() if not path_exists(spark, p)]
    if gone:
        raise FileNotFoundError(f"missing input tables: {gone}")
    return {n: read_table(spark, p, schemas[n], fmt) for n, p in paths.items()}


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str:
    """The first candidate that exists."""
    for p in paths:
        if path_exists(spark, p):
            return p
    raise FileNotFoundError(f"none of {list(paths)}")


def load_baseline(spark: SparkSession, baseline: str, fallbacks: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """The monitoring baseline; if absent, the first fallback becomes the baseline."""
    if path_exists(spark, baseline):
        return spark.read.format(fmt).load(baseline)
    write_table(spark.read.format(fmt).load(first_existing(spark, fallbacks)), baseline, fmt)
    return spark.read.format(fmt).load(baseline)


def read_audit_log(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with a nested struct; unreadable lines are skipped."""
    return spark.read.schema(AUDIT).option("mode", "DROPMALFORMED").json(path).where(F.col("timestamp").isNotNull())


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by: Sequence[str] = ()) -> str:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    return write_table(df, path, fmt, "append")


def file_fingerprint(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """File, size, number of rows and content hash of each file of a table.

    Rows are hashed where they are read (see ``table_fingerprint``), so a file of any size is split like in any scan
    and never is one value. ``fmt`` is taken from the path's ending by default; unknown endings are hashed as text
    lines. Files without rows have 0 rows.
    """
    ending = path.rstrip("/").rsplit(".", 1)[-1]
    fmt = fmt or (ending if ending in ("csv", "json", "orc", "parquet") else "text")
    rows = spark.read.format("text" if fmt in ("csv", "json") else fmt).load(path)
    n_rows, *sums = row_hash_sums([F.col(f"`{c}`") for c in rows.columns])
    hashed = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(n_rows, *sums)
    files = spark.read.format("binaryFile").load(path).select("_metadata.file_name", F.col("length").alias("size_bytes"))
    return files.withColumnRenamed("file_name", "file").join(hashed, "file", "left").select(
        "file", "size_bytes", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.when(F.col("n_rows").isNotNull(), hash_text()).alias("content_hash"))


def append_version_log(spark: SparkSession, sources: Mapping[str, str], log_path: str) -> DataFrame:
    """One appended row per source file: table, file, size, rows, content hash and time of reading."""
    out = None
    for table, path in sources.items():
        part = file_fingerprint(spark, path).select(F.lit(table).alias("table_name"), "*", F.current_timestamp().alias("versioned_at"))
        out = part if out is None else out.unionByName(part)
    out.write.mode("append").parquet(log_path)
    return spark.read.parquet(log_path)


def audit_rows(scored: DataFrame, key: str, p: str, protected: Sequence[str], tier: str = "risk_tier", timestamp=None) -> DataFrame:
    """Scored rows in the audit layout: protected attributes nested, never among the features."""
    return scored.select(
        (timestamp if timestamp is not None else F.current_timestamp()).cast("timestamp").alias("timestamp"),
        F.coalesce(F.col(key).cast("string"), F.lit("unknown")).alias("customer_id"), F.col(p).cast("double").alias("probability"),
        F.struct(*[F.col(c).cast("string").alias(c) for c in protected]).alias("protected_attributes"),
        F.col(tier).alias("risk_tier"))


def append_audit(rows: DataFrame, path: str) -> str:
    """Append-only JSON lines."""
    rows.write.mode("append").json(path)
    return path
