"""Instrument master: CSV ingest, snapshots, scans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import instrument_key, parse_date, split_part, time_seconds
from ..schemas import RAW_MASTER_COLUMNS, RAW_MASTER_SCHEMA

MASTER_COLUMNS = [
    "exchange", "segment", "security_id", "instrument_type", "expiry_code",
    "trading_symbol", "lot_units", "display_name", "expiry_raw", "strike_price",
    "option_type", "tick_size", "expiry_type", "instrument_key",
    "expiry_date_str", "expiry_time_str", "expiry_date", "expiry_time_s",
]


#: A column of the header that no data row holds as a value.
HEADER_MARK = "SEM_SMST_SECURITY_ID"


def _files_by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Header line -> files that have it (one row per file reaches the driver)."""
    lines = spark.read.text(path).where(F.col("value").contains(HEADER_MARK))
    out: dict[str, list[str]] = {}
    for r in lines.select("value", F.col("_metadata.file_path").alias("file")).distinct().collect():
        out.setdefault(r["value"], []).append(r["file"])
    return out


def read_master_csv(spark: SparkSession, path: str, bad_line: str | None = None) -> DataFrame:
    """Raw master CSV, columns matched by name: each file's own header gives
    their order, known columns have their type, further ones are text (types are
    never inferred).  A missing column is an error.  PERMISSIVE mode drops
    surplus tokens of ragged lines and nulls unparsable fields; ``bad_line``
    names a column that keeps the text of such lines."""
    by_header = _files_by_header(spark, path)
    if len(by_header) <= 1:
        return _read_csv_files(spark, [path], bad_line)
    parts = [_read_csv_files(spark, files, bad_line) for _, files in sorted(by_header.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _read_csv_files(spark: SparkSession, paths: list[str], bad_line: str | None) -> DataFrame:
    names = spark.read.option("header", True).csv(paths).columns
    known = {f.name.strip(): f for f in RAW_MASTER_SCHEMA.fields}
    missing = sorted(set(known) - {n.strip() for n in names})
    if missing:
        raise ValueError(f"the master file lacks the columns {missing}")
    fields = [known.get(n.strip(), T.StructField(n, T.StringType())) for n in names]
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", True)
    if bad_line:
        fields.append(T.StructField(bad_line, T.StringType()))
        reader = reader.option("columnNameOfCorruptRecord", bad_line)
    return reader.schema(T.StructType(fields)).csv(paths)


def ingest_master(raw: DataFrame, counts: Observation | None = None, bad_line: str | None = None) -> DataFrame:
    """S1 derivations: canonical names, key, expiry split and parse.

    Unparsable expiry dates/times become null instead of failing the whole
    ingest (D11).  ``counts`` observes, in the job that uses the result, how many
    there were: ``rows``, ``bad_dates``, ``bad_times`` and, with the ``bad_line``
    column of ``read_master_csv``, ``bad_lines`` (lines with a field that does not
    parse, or too few or too many of them).
    """
    renamed = raw.withColumnsRenamed({k: v for k, v in RAW_MASTER_COLUMNS.items() if k in raw.columns})
    out = (renamed
           .withColumns({
               "instrument_key": instrument_key("security_id", "segment", "exchange"),
               "expiry_date_str": split_part("expiry_raw", 0),
               "expiry_time_str": split_part("expiry_raw", 1),
           })
           .withColumns({
               "expiry_date": parse_date("expiry_date_str"),
               "expiry_time_s": time_seconds("expiry_time_str"),
           }))
    if counts is not None:
        def unread(text: str, value: str):
            there = F.coalesce(F.col(text), F.lit("")) != ""
            return F.count_if(there & F.col(value).isNull())

        measured = [F.count(F.lit(1)).alias("rows"), unread("expiry_date_str", "expiry_date").alias("bad_dates"),
                    unread("expiry_time_str", "expiry_time_s").alias("bad_times")]
        if bad_line:
            measured.append(F.count(F.col(bad_line)).alias("bad_lines"))
        out = out.observe(counts, *measured)
    rest = [c for c in renamed.columns if c not in MASTER_COLUMNS and c != bad_line]
    return out.select(*MASTER_COLUMNS, *(f"`{c}`" for c in rest))


def snapshot_date(ingest_ts) -> "F.Column":
    """A file fetched before 08:30 belongs to the previous day's snapshot."""
    ts = F.col(ingest_ts) if isinstance(ingest_ts, str) else ingest_ts
    return F.to_date(ts - F.expr("INTERVAL '08:30' HOUR TO MINUTE"))


def write_snapshot(master: DataFrame, path: str, ingest_ts: str, mode: str = "append") -> None:
    """Append one ingest as a ``snapshot_date`` partition."""
    (master.withColumn("snapshot_date", snapshot_date(F.lit(ingest_ts).cast("timestamp_ntz")))
     .write.mode(mode).partitionBy("snapshot_date").parquet(path))


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """Rows of the newest ``snapshot_date``, lazily: a one-row aggregate
    broadcast into a left-semi join (for derived frames; a snapshot folder
    is better read with ``scan_master``, which prunes partitions)."""
    newest = snapshots.agg(F.max("snapshot_date").alias("_newest"))
    return (snapshots.join(F.broadcast(newest), F.col("snapshot_date") == F.col("_newest"), "left_semi"))


def scan_master(spark: SparkSession, path: str) -> DataFrame:
    """S3: the current master of a snapshot folder.  The newest partition
    value is read first (a scalar; only the partition column is touched),
    then used as a literal filter, so only that partition's files are
    scanned (static partition pruning)."""
    snaps = spark.read.parquet(path)
    newest = snaps.agg(F.max("snapshot_date")).first()[0]
    if newest is None:
        return snaps.limit(0)
    return snaps.where(F.col("snapshot_date") == F.lit(newest))


def needs_refresh(snapshots: DataFrame, now_ts: str) -> DataFrame:
    """One row, ``stale`` = no snapshot yet, or the newest one is older
    than the snapshot a fetch at ``now_ts`` would produce (08:30 cut-off)."""
    newest = snapshots.agg(F.max("snapshot_date").alias("newest"))
    due = snapshot_date(F.lit(now_ts).cast("timestamp_ntz"))
    return newest.select("newest", due.alias("due"),
                         (F.col("newest").isNull() | (F.col("newest") < due)).alias("stale"))


def file_is_stale(modified, now) -> Column:
    """S2's rule on file times: fetch again unless the file was written after
    08:30 of the day it is now, also when it is not yet 08:30."""
    written, at = (F.col(x) if isinstance(x, str) else x for x in (modified, now))
    return F.coalesce(F.to_timestamp_ntz(F.concat(F.to_date(at).cast("string"), F.lit(" 08:30:00"))) >= written, F.lit(True))


def files_need_refresh(spark: SparkSession, path: str, now: DataFrame, fmt: str = "parquet") -> DataFrame:
    """S2 on the files of a stored master: one row per ``now_ts`` of ``now``
    with the newest file's time (session time zone) and whether it is stale."""
    files = spark.read.format(fmt).load(path).select(F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("t"))
    written = files.agg(F.max("t").alias("t")).scalar()
    return now.select("now_ts", written.alias("written")).select("now_ts", "written", file_is_stale("written", "now_ts").alias("stale"))
