"""Report tables that change by commits only.

Every run writes its rows into folders of its own and then commits one small file that says which hours of which
reports they are:

    <path>/report=<name>/run=<run>/dt=<day>/hour=<hour>/part-*    rows, never rewritten
    <path>/_commits/<run>/part-*.json                             one file per run, written last

Readers resolve the commits (`live_partitions`) and read what they name, so a run that was killed is invisible, a
replay takes over all its hours at once, and an hour that it finds empty is empty. The commit is a single file that
one rename puts in place; nothing is ever overwritten, which also suits object stores.

An entry of a commit is (report, dt, hour, part). Without a `part` it holds the whole hour and takes the place of all
entries up to its version (`upto`); entries with a `part`, e.g. of a stream's batch, stand beside each other, and only
the same part takes their place. Versions count up from the commits present; of runs that commit at the same time, the
greater run id stands. A table without times has the one partition `all`/`all`.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMITS = "_commits"
#: `dt` and `hour` of a table without times.
WHOLE = "all"
ENTRY = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("run", "report", "dt", "hour", "part")]
    + [T.StructField(n, T.LongType()) for n in ("version", "upto")]
)
_PARTITION = ["report", "dt", "hour"]


def new_run(label: str = "run") -> str:
    return f"{label}-{uuid.uuid4().hex}"


def _read(reader, path: str) -> DataFrame | None:
    try:
        return reader(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def commits(spark: SparkSession, path: str) -> DataFrame:
    """All entries of all commits."""
    found = _read(spark.read.option("recursiveFileLookup", "true").schema(ENTRY).json, f"{path.rstrip('/')}/{COMMITS}")
    return spark.createDataFrame([], ENTRY) if found is None else found


def live_partitions(entries: DataFrame) -> DataFrame:
    """The entries whose rows make up the table; at most one per (report, dt, hour, part)."""
    whole = F.col("part").isNull()
    order = F.struct("upto", "version", "run")
    hour = Window.partitionBy(*_PARTITION)
    newest = F.max(order).over(Window.partitionBy(*_PARTITION, "part"))
    return (
        entries.dropDuplicates(ENTRY.fieldNames())
        .withColumn("_whole", F.max(F.when(whole, order)).over(hour))
        .withColumn("_newest", newest)
        .where(order == F.col("_newest"))
        .where(whole | F.col("_whole").isNull() | (F.col("version") > F.col("_whole")["upto"]))
        .select(*ENTRY.fieldNames())
    )


def latest_version(spark: SparkSession, path: str) -> int:
    return commits(spark, path).agg(F.max("version")).first()[0] or 0


def run_folder(path: str, report: str, run: str) -> str:
    return f"{path.rstrip('/')}/report={report}/run={run}"


def write_rows(rows: DataFrame, path: str, report: str, run: str, time: Column | None = None, fmt: str = "json") -> None:
    """Write a report's rows for a run; `time` is their `yyyyMMddHHmmss`, None for a table without times.

    The rebalance hint gathers the rows of an hour in few files and lets adaptive execution split a large hour. The
    folder is the run's own, so an attempt that is made again replaces only what the attempt before it left.
    """
    if time is None:
        stamped = rows.withColumns({"dt": F.lit(WHOLE), "hour": F.lit(WHOLE)})
    else:
        day = F.concat_ws("-", F.substring(time, 1, 4), F.substring(time, 5, 2), F.substring(time, 7, 2))
        stamped = rows.withColumns({"dt": day, "hour": F.substring(time, 9, 2)})
    stamped.hint("rebalance", F.col("dt"), F.col("hour")).write.mode("overwrite").partitionBy("dt", "hour").format(fmt).save(
        run_folder(path, report, run)
    )


def hours_between(spark: SparkSession, reports: Iterable[str], start: datetime, end: datetime) -> DataFrame:
    """(report, dt, hour) of all whole hours in [start, end), UTC."""
    names = spark.createDataFrame([(n,) for n in reports], "report string")
    bounds = [F.lit(t.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz") for t in (start, end)]
    hour = F.explode(F.sequence(bounds[0], bounds[1] - F.expr("INTERVAL 1 HOUR"), F.expr("INTERVAL 1 HOUR")))
    return names.select("report", hour.alias("h")).select(
        "report", F.date_format("h", "yyyy-MM-dd").alias("dt"), F.date_format("h", "HH").alias("hour")
    )


def written_hours(spark: SparkSession, path: str, reports: Iterable[str], run: str, fmt: str = "json") -> DataFrame:
    """(report, dt, hour) of the rows that a run has written."""
    out = spark.createDataFrame([], "report string, dt string, hour string")
    for name in reports:
        found = _read(spark.read.schema("dt string, hour string").format(fmt).load, run_folder(path, name, run))
        if found is not None:
            out = out.union(found.where(F.col("dt").isNotNull()).select(F.lit(name).alias("report"), "dt", "hour").distinct())
    return out


def commit(spark: SparkSession, path: str, run: str, entries: DataFrame, part: str | None = None, upto: int | None = None) -> int:
    """Make the run's rows the content of the partitions `entries` (report, dt, hour); returns the version.

    `upto` is the last version whose entries it takes the place of (its own by default): a job that rewrites what it
    read names the version that it read, and leaves later commits standing.
    """
    version = latest_version(spark, path) + 1
    rows = entries.select(
        F.lit(run).alias("run"),
        "report",
        "dt",
        "hour",
        F.lit(part).cast("string").alias("part"),
        F.lit(version).cast("long").alias("version"),
        F.lit(version if upto is None else upto).cast("long").alias("upto"),
    ).distinct()
    rows.coalesce(1).write.mode("error").json(f"{path.rstrip('/')}/{COMMITS}/{run}")
    return version


def replaced_by_all(spark: SparkSession, path: str, reports: list[str], run: str, fmt: str = "json") -> DataFrame:
    """Entries of a run over all records: the hours it wrote, and those that its reports have now."""
    present = live_partitions(commits(spark, path)).where(F.col("report").isin(reports) & (F.col("dt") != WHOLE))
    return written_hours(spark, path, reports, run, fmt).union(present.select(*_PARTITION)).distinct()


def read_committed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    report: str | None = None,
    stamp_cols: Iterable[str] = ("report", "dt", "hour"),
    fmt: str = "json",
) -> DataFrame:
    """The rows of the table, or of one report, with `schema` and the columns `stamp_cols`, all read as strings.

    Filters on report, dt and hour prune folders; the join with the live entries prunes runs.
    """
    root = path.rstrip("/")
    stamps = [c for c in dict.fromkeys([*stamp_cols, "report", "dt", "hour", "run"]) if c not in schema.fieldNames()]
    full = T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in stamps]])
    where = root if report is None else f"{root}/report={report}"
    keep = [*schema.fieldNames(), *[c for c in stamp_cols if c not in schema.fieldNames()]]
    rows = _read(spark.read.option("basePath", root).schema(full).format(fmt).load, where)
    if rows is None:
        return spark.createDataFrame([], full).select(*keep)
    live = live_partitions(commits(spark, path)).select("report", "run", "dt", "hour")
    return rows.join(live, ["report", "run", "dt", "hour"], "left_semi").select(*keep)


def compact(spark: SparkSession, path: str, before: str) -> list[str]:
    """Rewrite the hours before `before` (`yyyy-MM-ddTHH`) that lie in several runs as one run each; returns the reports.

    For tables of JSON lines: rows are carried as text, whatever their report. An hour in one run is left alone, so a second call does nothing.
    Commits that come in meanwhile stay: the new run takes the place of what it has read only. One job per report.
    """
    base = latest_version(spark, path)
    day, hour = before.split("T")
    closed = (F.col("dt") < day) | ((F.col("dt") == day) & (F.col("hour") < hour))
    live = live_partitions(commits(spark, path).where(F.col("version") <= base)).where((F.col("dt") != WHOLE) & closed)
    many = live.withColumn("_runs", F.count(F.lit(1)).over(Window.partitionBy(*_PARTITION))).where("_runs > 1")
    reports = sorted(r.report for r in many.select("report").distinct().collect())
    if not reports:
        return []
    run, root = new_run("compact"), path.rstrip("/")
    for report in reports:
        mine = many.where(F.col("report") == report).select("run", "dt", "hour")
        lines = _read(spark.read.schema("value string, run string, dt string, hour string").text, f"{root}/report={report}")
        if lines is not None:
            lines.join(mine, ["run", "dt", "hour"], "left_semi").select("value", "dt", "hour").hint(
                "rebalance", F.col("dt"), F.col("hour")
            ).write.mode("overwrite").partitionBy("dt", "hour").text(run_folder(path, report, run))
    commit(spark, path, run, many.select(*_PARTITION).distinct(), upto=base)
    return reports


def vacuum(spark: SparkSession, path: str) -> int:
    """Fold all commits into one and delete the rows that no reader can reach any more; returns the folders deleted.

    Only folders of committed runs go: a run without a commit may be at work. Readers that resolved the commits before
    should have finished.
    """
    root = path.rstrip("/")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(f"{root}/{COMMITS}")
    fs = folder.getFileSystem(conf)
    if not fs.exists(folder):
        return 0
    old = [s.getPath() for s in fs.listStatus(folder)]
    entries = spark.read.schema(ENTRY).json([p.toString() for p in old])
    live = live_partitions(entries)
    kept = live.select("report", "run").distinct()
    dead = entries.select("report", "run").distinct().join(kept, ["report", "run"], "left_anti")
    dead = [run_folder(path, r.report, r.run) for r in dead.toLocalIterator()]
    live.coalesce(1).write.mode("error").json(f"{root}/{COMMITS}/{new_run('fold')}")
    for place in [*old, *[jvm.org.apache.hadoop.fs.Path(d) for d in dead]]:
        fs.delete(place, True)
    return len(dead)
