"""Landing CSV drops -> raw zone.

A drop is ``<folder>/<folder>_<yyyyMMddHHmmss>.csv``: either one file put
there by a producer, or a directory of that name holding the part files a
Spark job wrote.  The 14-digit stamp in the name is data: it versions every
row of the drop.  Landing is read all-string against an explicit schema.

Nothing wrong loads silently: a line with too few or too many fields, or with an
open quote, is kept as text and rejected (``malformed_line``), as are the rows
of files without a stamp (``file_without_stamp``).  A header that differs from
the contract fails a batch read (``enforceSchema=false``, D21); a stream,
which a bad drop must not stop, sets all rows of such a file aside
(``header_drift``, :func:`with_header_check`).
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from terrace.schema import INGEST, RAW_PARTITIONS, REF_DAY, REF_DAY_PARTITION, REF_FILE, REF_FILE_PARTITION

WHOLE_DROP = "drop"      # ingest unit of a batch that holds whole drops
LANDING_FILE = "landing_file"
LANDING_LINE = "landing_line"    # the text of a line that does not fit the contract, else NULL
DRIFT = "header_drift"
STAMP_PATTERN = r"_([0-9]{14})\.csv(/[^/]*)?$"


def landing_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def file_stamp(path: Column) -> Column:
    """Trailing 14-digit stamp of a drop name as bigint; NULL when the name has none."""
    return F.regexp_extract(path, STAMP_PATTERN, 1).try_cast("bigint")


def csv_options(reader, columns: Sequence[str], check_header: bool = True):
    """A batch or stream reader set up for landing files of ``columns``."""
    return (reader.schema(landing_schema([*columns, LANDING_LINE]))
            # all fields of a line are counted, whichever columns a query needs
            .option("columnPruning", False)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LANDING_LINE)
            .option("header", True).option("enforceSchema", not check_header)
            .option("encoding", "UTF-8").option("sep", ",").option("escape", '"'))     # a quote is doubled


def csv_reader(spark: SparkSession, columns: Sequence[str]):
    return csv_options(spark.read, columns).option("recursiveFileLookup", True)


def read_landing(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """All-string landing rows plus ``ref_file_extraction``, their file's path, and the text
    of lines that do not fit."""
    return stamped(csv_reader(spark, columns).csv(path), columns)


def stamped(scanned: DataFrame, columns: Sequence[str]) -> DataFrame:
    path = F.col("_metadata.file_path")
    # a query of rejected lines alone must still name a parsed column, else Spark refuses it
    line = F.concat(LANDING_LINE, F.substring(F.coalesce(columns[0], F.lit("")), 1, 0)).alias(LANDING_LINE)
    return scanned.select(*columns, line, file_stamp(path).alias(REF_FILE), path.alias(LANDING_FILE))


def file_headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """landing_file, header: the first line of every file (one row a file and task is shuffled)."""
    lines = spark.read.text([unquote(p) for p in paths]).where(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias(LANDING_FILE), "value", F.monotonically_increasing_id().alias("at"))
    return lines.groupBy(LANDING_FILE).agg(F.min_by("value", "at").alias("header"))


def header_fields(header: Column) -> Column:
    """Field names of a header line, without byte order mark, quotes and surrounding space."""
    bare = F.regexp_replace(header, "^\uFEFF|\r$", "")
    return F.transform(F.split(bare, ","), lambda f: F.regexp_replace(F.trim(f), '^"(.*)"$', "$1"))


def with_header_check(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``header_drift``: the row's file has another header than the contract."""
    return header_checked(rows, columns)[0]


def header_checked(rows: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, bool, list[str]]:
    """``rows`` with ``header_drift``, whether any of them is rejected, and the files they come from.

    The list of a micro-batch's files comes to the driver, where the file source has it anyway; the
    pass that lists them also sees rejects.  The few files that drifted are named in the filter: no
    row is shuffled to learn of them, and headers are read once, whatever uses the rows.
    """
    spark = rows.sparkSession
    files = rows.groupBy(LANDING_FILE).agg(F.max(reject_reason(rows).isNotNull()).alias("bad")).collect()
    drifted = []
    if files:
        ok = header_fields(F.col("header")) == F.array(*[F.lit(c) for c in columns])
        drifted = [r[0] for r in file_headers(spark, [f[LANDING_FILE] for f in files]).where(~ok)
                   .select(LANDING_FILE).collect()]
    out = rows.withColumn(DRIFT, F.col(LANDING_FILE).isin(drifted) if drifted else F.lit(False))
    return out, bool(drifted) or any(f["bad"] for f in files), [unquote(f[LANDING_FILE]) for f in files]


def reject_reason(landing: DataFrame) -> Column:
    """Why a landing row is not loaded; NULL for rows that are."""
    why = F.when(F.col(REF_FILE).isNull(), F.lit("file_without_stamp"))
    if DRIFT in landing.columns:
        why = why.when(F.col(DRIFT), F.lit(DRIFT))
    return why.when(F.col(LANDING_LINE).isNotNull(), F.lit("malformed_line"))


def accepted(landing: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Landing rows that fit the contract: landing columns and the file stamp."""
    return landing.where(reject_reason(landing).isNull()).select(*columns, REF_FILE)


def to_raw(landing: DataFrame, columns: Sequence[str], ref_day: int) -> DataFrame:
    """Stamp landing rows for the raw zone.

    ``ref_day`` is one explicit batch argument (D17); rows that do not fit the
    contract are not raw rows (see :func:`rejected`).
    """
    return (accepted(landing, columns)
            .select(F.lit(ref_day).cast("int").alias(REF_DAY),
                    F.lit(ref_day).cast("int").alias(REF_DAY_PARTITION),
                    F.col(REF_FILE), F.col(REF_FILE).alias(REF_FILE_PARTITION),
                    *[F.col(c).cast("string") for c in columns]))


def rejected(landing: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that are not loaded, with the reason, their file and, for a malformed line, its text."""
    return (landing.withColumn("reason", reject_reason(landing)).where(F.col("reason").isNotNull())
            .select("reason", LANDING_FILE, LANDING_LINE, *columns))


def drop_path(landing_root: str, folder: str, stamp: int) -> str:
    return f"{landing_root.rstrip('/')}/{folder}/{folder}_{stamp:014d}.csv"


def write_drop(df: DataFrame, landing_root: str, folder: str, stamp: int,
               columns: Sequence[str], mode: str = "overwrite", packed_rows: int | None = None) -> str:
    """Write one stamped drop (all-string CSV with header) and return its path.

    ``mode="append"`` adds part files to a drop that has landed in part.  With ``packed_rows``
    the part files are compressed, and hold at most so many rows, as one task reads a file.
    """
    path = drop_path(landing_root, folder, stamp)
    writer = (df.select(*[F.col(c).cast("string") for c in columns])
              .write.mode(mode).option("header", True).option("escape", '"'))
    if packed_rows:
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", packed_rows)
    writer.csv(path)
    return path


def write_raw(raw: DataFrame, raw_path: str, ingest: str = WHOLE_DROP) -> None:
    """Append a batch to the raw zone, idempotently.

    Partitioned by (batch day, file stamp, ingest unit); dynamic partition
    overwrite replaces only the partitions this batch writes.  A replayed
    unit replaces itself; the parts of a drop that arrive in other units
    stay.
    """
    # rebalanced by partition: files of the advisory size instead of one per task and partition (K1)
    (raw.withColumn(INGEST, F.lit(ingest)).hint("rebalance", *RAW_PARTITIONS).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*RAW_PARTITIONS).parquet(raw_path))


def write_rejected(rows: DataFrame, rejected_path: str, ingest: str) -> None:
    """Keep what an ingest unit rejects; a replayed unit replaces its own folder."""
    rows.write.mode("overwrite").parquet(f"{rejected_path}/{INGEST}={ingest}")


def compact_raw(spark: SparkSession, raw_path: str, units: Sequence[str], columns: Sequence[str],
                work_path: str) -> None:
    """Rewrite the files of some ingest units in advisory sizes, each under its own identity.

    The rows go to ``work_path`` (shared, fresh) first and from there over their
    own partitions, since a table is never overwritten from its own files.  A crash
    in between leaves whole partitions, old or new; running it again is safe.
    """
    rows = read_raw(spark, raw_path, columns, with_ingest=True).where(F.col(INGEST).isin(list(units)))
    rows.write.mode("overwrite").parquet(work_path)
    (spark.read.schema(rows.schema).parquet(work_path).hint("rebalance", *RAW_PARTITIONS).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*RAW_PARTITIONS).parquet(raw_path))


def raw_schema(columns: Sequence[str]) -> StructType:
    lineage = f"{REF_DAY} int, {REF_FILE} bigint"
    parts = f"{REF_DAY_PARTITION} int, {REF_FILE_PARTITION} bigint, {INGEST} string"
    return StructType([*StructType.fromDDL(lineage).fields, *landing_schema(columns).fields,
                       *StructType.fromDDL(parts).fields])


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path``, or no rows where nothing was ever written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_raw(spark: SparkSession, raw_path: str, columns: Sequence[str] | None = None,
             with_ingest: bool = False) -> DataFrame:
    """Raw rows; with ``columns``, an empty table where no drop was ever ingested."""
    raw = (spark.read.parquet(raw_path) if columns is None
           else read_or_empty(spark, raw_path, raw_schema(columns)))
    return raw if with_ingest else raw.drop(INGEST)


def read_batch(spark: SparkSession, raw_path: str, ref_day: int,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Today's batch only: a partition filter, pruned at planning."""
    return read_raw(spark, raw_path, columns).where(F.col(REF_DAY_PARTITION) == F.lit(ref_day))
