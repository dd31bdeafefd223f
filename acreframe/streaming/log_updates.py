"""The download database kept up to date from new log batches: by merging whole tables, or from the state of each log."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from acreframe.operators.logs import MOST_CORES, USUAL_CORES, by_cell, cell_of_file, merge_status, parse_lines, roll_up


def _versions(spark: SparkSession, store: str) -> list[int]:
    """Numbers of the complete versions in a store: those whose last file, the writer's _SUCCESS, is there."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{store}/version-*/_SUCCESS")
    found = path.getFileSystem(conf).globStatus(path)
    return sorted(int(f.getPath().getParent().getName().removeprefix("version-")) for f in found or [])


def current_status(spark: SparkSession, store: str) -> DataFrame | None:
    """The newest complete version of the status table."""
    known = _versions(spark, store)
    return spark.read.parquet(f"{store}/version-{known[-1]}") if known else None


def apply_batch(store: str, lines: DataFrame, start_date: str | None = None, stop_date: str | None = None, ignore: tuple[str, str] | None = None, batch: int | None = None) -> str:
    """Merge a batch of log lines(file, line_no, line) into the status table; returns where the version that holds it is.

    store: a folder of versions, numbered by batch (without one: the next number).  A version counts once it is complete, so a
    batch that dies leaves the table as it was, and one that is already in it changes nothing when it comes again.
    """
    spark = lines.sparkSession
    known = _versions(spark, store)
    if batch is None:
        batch = known[-1] + 1 if known else 0
    if known and known[-1] >= batch:
        return f"{store}/version-{known[-1]}"
    new = roll_up(lines, start_date, stop_date, ignore)
    old = spark.read.parquet(f"{store}/version-{known[-1]}") if known else new.limit(0)
    version = f"{store}/version-{batch}"
    merge_status(old, new, start_date, stop_date, ignore).drop("archivable").write.mode("overwrite").parquet(version)
    return version


def watch_logs(lines: DataFrame, store: str, checkpoint: str, start_date: str | None = None, stop_date: str | None = None, ignore: tuple[str, str] | None = None) -> StreamingQuery:
    """The same for a stream of log lines: each micro-batch is merged by foreachBatch under its number, all that's there now."""
    return lines.writeStream.foreachBatch(lambda frame, batch: apply_batch(store, frame, start_date, stop_date, ignore, batch) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


_FILE = "file string, cell_id int, minutes long, cores int, first date, last date, ranges array<struct<start:date,end:date>>, n long, errors array<struct<start:date,end:date>>"
_FIELDS = ("line_no", "named", "start", "end", "minutes", "cores", "is_error")


def file_row(lines: dict[int, tuple]) -> dict:
    """What a log brings to its cell: lines by number, each (cell, start, end, minutes, cores, whether it's an error), dates in ISO form."""
    known = [lines[k] for k in sorted(lines)]
    ranges, errors, at = {(a, b) for _, a, b, *_ in known if a and b}, set(), (None, None)
    for _, a, b, _, _, error in known:
        at = (a or at[0], b or at[1])
        if error and at[0]:
            errors.add(at)
    cores, minutes = [x[4] for x in known if x[4] is not None], [x[3] for x in known if x[3] is not None]
    most = max(cores, default=None)
    day = lambda d: dt.date.fromisoformat(d) if d else None
    pairs = lambda found: [{"start": day(a), "end": day(b)} for a, b in sorted(found, key=str)]
    return {
        "cell_id": max((x[0] for x in known if x[0] is not None), default=None), "minutes": sum(minutes) if minutes else None, "cores": USUAL_CORES if most is None or most > MOST_CORES else most,
        "first": day(min((x[1] for x in known if x[1]), default=None)), "last": day(max((x[2] for x in known if x[2]), default=None)), "ranges": pairs(ranges), "n": sum(1 for x in known if x[1] and x[2]), "errors": pairs(errors),
    }


def _update(key: tuple[str], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Takes new lines of a log into its state; lines that are there already, or come late or again, make no difference to the row."""
    lines = {int(k): tuple(v) for k, v in json.loads(state.get[0]).items()} if state.exists else {}
    text = lambda v: None if v is None or v is pd.NaT or v != v else v.isoformat()
    number = lambda v: None if v is None or v != v else int(v)
    for part in parts:
        for no, cell, start, end, minutes, cores, error in part[list(_FIELDS)].itertuples(index=False, name=None):
            lines[int(no)] = (number(cell), text(start), text(end), number(minutes), number(cores), bool(error))
    state.update((json.dumps(lines),))
    row = file_row(lines)
    row["cell_id"] = row["cell_id"] if row["cell_id"] is not None else number(part["numbered"].iloc[0])
    out = pd.DataFrame([{"file": key[0], **row}])
    yield out.astype({"cell_id": "Int32", "minutes": "Int64", "cores": "Int32", "n": "Int64"}).assign(first=out["first"].astype(object), last=out["last"].astype(object))


def watch_files(lines: DataFrame, store: str, checkpoint: str) -> StreamingQuery:
    """Follow a stream of log lines(file, line_no, line): each log's state is kept by file, and a micro-batch writes a row for each log it touches.

    A log's state is its lines that say something, by number; so lines may come in any order, split anyhow, and more than once.  A batch is written under its
    number in `store`, so one that comes again after a restart replaces itself.  file_status makes the table of cells.
    """
    told = F.col("cell_id").isNotNull() | F.col("start").isNotNull() | F.col("end").isNotNull() | F.col("minutes").isNotNull() | F.col("cores").isNotNull() | F.col("is_error")
    rows = parse_lines(lines).where(told).withColumnRenamed("cell_id", "named").withColumn("numbered", cell_of_file(F.col("file")))
    rows = rows.groupBy("file").applyInPandasWithState(_update, _FILE, "lines string", "update", GroupStateTimeout.NoTimeout)
    write = lambda frame, batch: frame.write.mode("overwrite").parquet(f"{store}/batch={batch}")
    return rows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def file_status(spark: SparkSession, store: str, start_date: str | None = None, stop_date: str | None = None, ignore: tuple[str, str] | None = None) -> DataFrame:
    """dl_status of all logs that watch_files has followed: the newest row of each log, rolled up by cell as roll_up does."""
    rows = spark.read.schema(f"{_FILE}, batch long").parquet(store)
    names = [c for c in rows.columns if c not in ("file", "batch")]
    newest = rows.groupBy("file").agg(F.max_by(F.struct(*names), "batch").alias("r")).select("file", "r.*")
    return by_cell(newest, start_date, stop_date, ignore)
