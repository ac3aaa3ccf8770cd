"""Bad records of a sink, kept beside it: each once, by where it came from.

A record is known by its kind, its source (a Kafka message `topic/partition@offset`, or the file it stands in) and its
text; `copies` counts equal texts of one file. A run adds only records that are not there yet, under a commit of its
own, so runs add up, a rerun adds none and a killed run leaves nothing behind. Mended records are stored in the same
way and are part of every later replay (`flowstats.batch_job --mended`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowstats.schemas import CORRUPT_RECORD
from flowstats.sinks.committed import WHOLE, commit, new_run, read_committed, run_folder, write_rows, written_hours
from flowstats.sources.json_records import SOURCE

RECORD = T.StructType(
    [T.StructField(n, T.LongType() if n == "copies" else T.StringType()) for n in ("id", "kind", "source", "bad_record", "copies", "found_at")]
)
#: A mended record names the bad one it stands for in this field.
MENDED_ID = "quarantine_id"


def quarantine_path(sink_path: str) -> str:
    """Folder of the bad records of a sink, beside it."""
    return f"{sink_path.rstrip('/')}-quarantine"


def mended_path(sink_path: str) -> str:
    return f"{sink_path.rstrip('/')}-mended"


def _source(records: DataFrame) -> Column:
    return F.coalesce(F.col(SOURCE), F.lit("")) if SOURCE in records.columns else F.lit("")


def identified(bad: DataFrame, kind: str, found_at: Column | None = None) -> DataFrame:
    """Rows of `RECORD` from bad records, equal texts of one source counted once."""
    when = F.lit(None).cast("string") if found_at is None else found_at
    records = bad.select(_source(bad).alias("source"), F.col(CORRUPT_RECORD).alias("bad_record"), when.alias("found_at"))
    return (
        records.groupBy("source", "bad_record")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("found_at").alias("found_at"))
        .select(
            F.sha2(F.concat_ws("\n", F.lit(kind), "source", "bad_record"), 256).alias("id"),
            F.lit(kind).alias("kind"),
            "source",
            "bad_record",
            "copies",
            "found_at",
        )
    )


def read_quarantine(spark: SparkSession, sink_path: str) -> DataFrame:
    """All bad records of the sink."""
    return read_committed(spark, quarantine_path(sink_path), RECORD, stamp_cols=())


def add_bad(bad: DataFrame, sink_path: str, kind: str, found_at: Column | None = None, part: str | None = None) -> None:
    """Store the bad records that are not stored yet.

    `part` names a stream's batch: its records take the place of what an earlier attempt at it stored, which needs no
    look at all the others.
    """
    rows = identified(bad, kind, found_at)
    if part is None:
        rows = rows.join(read_quarantine(bad.sparkSession, sink_path).select("id"), "id", "left_anti")
    _append(rows, quarantine_path(sink_path), kind, part)


def _append(rows: DataFrame, path: str, label: str, part: str | None = None) -> DataFrame:
    """`rows` under a commit of their own, as a part that takes the place of nothing else; returns them as stored."""
    spark, run = rows.sparkSession, new_run("add")
    write_rows(rows, path, label, run)
    here = written_hours(spark, path, [label], run)
    if here.isEmpty():
        return spark.createDataFrame([], rows.schema)
    commit(spark, path, run, here, part=part or run)
    return spark.read.schema(rows.schema).json(f"{run_folder(path, label, run)}/dt={WHOLE}/hour={WHOLE}")


def still_bad(spark: SparkSession, sink_path: str) -> DataFrame:
    """The bad records that no mended record stands for."""
    mended = read_mended(spark, sink_path).select(F.col("id"))
    return read_quarantine(spark, sink_path).join(mended, "id", "left_anti")


MENDED = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "kind", "value")])


def read_mended(spark: SparkSession, sink_path: str, kind: str | None = None) -> DataFrame:
    """The stored mended records as JSON text (`value`)."""
    return read_committed(spark, mended_path(sink_path), MENDED, kind, stamp_cols=())


def add_mended(values: DataFrame, sink_path: str, kind: str) -> DataFrame:
    """Store mended records (`value`, JSON text); those stored before are left out. Returns the added ones.

    A record is known by its `quarantine_id`, or by its text where it names none.
    """
    spark = values.sparkSession
    named = F.get_json_object("value", f"$.{MENDED_ID}")
    rows = values.where(F.length(F.trim("value")) > 0).select(
        F.coalesce(named, F.sha2(F.concat_ws("\n", F.lit(kind), "value"), 256)).alias("id"), F.lit(kind).alias("kind"), "value"
    )
    known = read_mended(spark, sink_path, kind).select("id")
    return _append(rows.dropDuplicates(["id"]).join(known, "id", "left_anti"), mended_path(sink_path), kind)
