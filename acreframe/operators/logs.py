"""Download logs: periods, gaps, errors and their roll-up by cell."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What names an error of a download in a log line.
ERRORS = ("TimeoutError", "pystac_client.exceptions.APIError", "urllib.error.HTTPError")
#: Cells of logs whose lines name none are numbered from these, and cores that are named beyond this aren't believed.
OLD_CELLS, NEW_CELLS, MOST_CORES, USUAL_CORES = 4000, 3000, 90, 4
_PAIRS = "array<struct<start:date,end:date>>"


def parse_lines(lines: DataFrame) -> DataFrame:
    """lines(file, line_no, line) with the fields that a line holds: cell, start, end, minutes, cores and error."""
    t = F.split(F.trim("line"), r"\s+")
    word = lambda n: F.try_element_at(t, F.lit(n))
    line = F.col("line")
    is_cell, works = line.startswith("cell_id"), line.contains("Working on")
    runtime, core = line.contains("full process took"), line.contains("core used")
    number = lambda: F.regexp_extract(line, r"(\d+)", 1).try_cast("int")
    period = lambda n: F.to_date(F.when(F.substring(word(n), 1, 10).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.substring(word(n), 1, 10)))
    # the period stands in tokens 4 and 6 where a backslash leads the line, one earlier where it doesn't
    at = F.when(line.startswith("\\"), 0).otherwise(-1)
    first, last = F.when(at == 0, period(4)).otherwise(period(3)), F.when(at == 0, period(6)).otherwise(period(5))
    return lines.select(
        "file", "line_no",
        F.when(is_cell, number()).alias("cell_id"),
        F.when(works, first).alias("start"), F.when(works, last).alias("end"),
        F.when(runtime, number()).alias("minutes"), F.when(core, number()).alias("cores"),
        F.coalesce(reduce(lambda a, b: a | b, [line.contains(e) for e in ERRORS]), F.lit(False)).alias("is_error"),
    )


def carried(parsed: DataFrame) -> DataFrame:
    """parsed with the cell of the file and the period each line falls in: the last one named before it."""
    line = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return parsed.withColumns({"cell_id": F.last("cell_id", True).over(line), "in_start": F.last("start", True).over(line), "in_end": F.last("end", True).over(line)})


def cell_of_file(file: Column) -> Column:
    """A cell from a log's number, where no line names one: 4000 on for numbers up to 100, else 3000 on."""
    n = F.regexp_extract(file, r"_(\d+)\.err$", 1).try_cast("int")
    return F.when(n < 101, n + OLD_CELLS).otherwise(n + NEW_CELLS)


def date_gaps(ranges: DataFrame, start_date: str | None = None, stop_date: str | None = None, key: str = "cell_id") -> DataFrame:
    """(key, start, end) between what ranges(key, start, end) cover, by the running maximum of ends.

    From 31 December to 1 January is no gap.  A first range that begins after start_date, and a last end before stop_date, leave gaps too;
    a key with one range has none.
    """
    line = Window.partitionBy(key).orderBy("start", "end")
    everything = Window.partitionBy(key)
    r = ranges.where("start is not null and end is not null").withColumns({"reached": F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1)), "n": F.count("*").over(everything)})
    turn = _turn(F.col("reached"), F.col("start"))
    inner = r.where((F.col("n") > 1) & (F.col("start") > F.col("reached")) & ~turn).select(key, F.col("reached").alias("start"), F.col("start").alias("end"))
    spans = ranges.where("start is not null and end is not null").groupBy(key).agg(F.min("start").alias("a"), F.max("end").alias("b"), F.count("*").alias("n")).where("n > 1")
    out = inner
    if start_date:
        first = F.lit(start_date).cast("date")
        out = out.union(spans.where(F.col("a") > first).select(key, first.alias("start"), F.col("a").alias("end")))
    if stop_date:
        last = F.lit(stop_date).cast("date")
        out = out.union(spans.where(F.col("b") < last).select(key, F.col("b").alias("start"), last.alias("end")))
    return out


def _turn(end: Column, start: Column) -> Column:
    """From 31 December to 1 January is no gap."""
    return (F.month(end) == 12) & (F.dayofmonth(end) == 31) & (start == F.date_add(end, 1))


def islands(ranges: Column) -> Column:
    """What an array of (start, end) covers, as such an array without overlaps, in order: the running maximum of ends carried through it."""
    last = lambda done: F.element_at(done, -1)

    def add(done: Column, r: Column) -> Column:
        joins = (r["start"] <= last(done)["end"]) | _turn(last(done)["end"], r["start"])
        longer = F.struct(last(done)["start"].alias("start"), F.greatest(last(done)["end"], r["end"]).alias("end"))
        return F.when((F.size(done) > 0) & joins, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))).otherwise(F.concat(done, F.array(r)))

    return F.aggregate(F.array_sort(ranges), F.expr(f"cast(array() as {_PAIRS})"), add)


def gaps_between(covered: Column, count: Column, start_date: str | None, stop_date: str | None) -> Column:
    """Gaps between the islands, and before the first and behind the last if dates are given; none where there's one range only."""
    pair = lambda a, b: F.struct(a.alias("start"), b.alias("end"))
    many = F.size(covered)
    out = [F.when(many > 1, F.transform(F.sequence(F.lit(1), F.greatest(many - 1, F.lit(1))), lambda i: pair(F.get(covered, i - 1)["end"], F.get(covered, i)["start"])))]
    if start_date:
        first, begin = F.lit(start_date).cast("date"), F.get(covered, F.lit(0))["start"]
        out.insert(0, F.when(begin > first, F.array(pair(first, begin))))
    if stop_date:
        last, end = F.lit(stop_date).cast("date"), F.element_at(covered, -1)["end"]
        out.append(F.when(end < last, F.array(pair(end, last))))
    none = F.expr(f"cast(array() as {_PAIRS})")
    return F.when((count > 1) & (many > 0), F.concat(*[F.coalesce(x, none) for x in out])).otherwise(none)


def _with_fixes(status: DataFrame, start_date: str | None, stop_date: str | None, ignore: tuple[str, str] | None) -> DataFrame:
    """Gaps of the ranges, and what is to be fixed: errors and gaps but for the ignored period."""
    out = status.withColumn("dllog_gaps", gaps_between(F.col("dllog_ranges"), F.col("n_ranges"), start_date, stop_date))
    fix = F.array_union("dllog_errors", "dllog_gaps")
    if ignore:
        first, last = (F.lit(d).cast("date") for d in ignore)
        fix = F.filter(fix, lambda e: ~((e["start"] == first) & (e["end"] == last)))
    return out.withColumn("dl_fix_now", fix)


def roll_up(lines: DataFrame, start_date: str | None = None, stop_date: str | None = None, ignore: tuple[str, str] | None = None) -> DataFrame:
    """dl_status rows from log lines: start, end, ranges covered, errors, runtime, core minutes (4 cores where none or over 90 are named), gaps.

    ignore: a period (start, end) whose error can't be fixed: it stays among the errors but not in dl_fix_now.  One window and one
    aggregate per file, which share its exchange, then one per cell; what a file brings there are its distinct periods.
    """
    rows = carried(parse_lines(lines))
    pair = F.struct("start", "end")
    wrong = F.struct(F.col("in_start").alias("start"), F.col("in_end").alias("end"))
    dated = F.col("start").isNotNull() & F.col("end").isNotNull()
    named = F.max("cores")
    cores = F.when(named.isNull() | (named > MOST_CORES), USUAL_CORES).otherwise(named)
    files = rows.groupBy("file").agg(
        F.coalesce(F.max("cell_id"), F.first(cell_of_file(F.col("file")))).alias("cell_id"), F.sum("minutes").alias("minutes"), cores.alias("cores"), F.min("start").alias("first"), F.max("end").alias("last"),
        F.collect_set(F.when(dated, pair)).alias("ranges"), F.count_if(dated).alias("n"), F.collect_set(F.when(F.col("is_error") & F.col("in_start").isNotNull(), wrong)).alias("errors"),
    )
    return by_cell(files, start_date, stop_date, ignore)


def by_cell(files: DataFrame, start_date: str | None = None, stop_date: str | None = None, ignore: tuple[str, str] | None = None) -> DataFrame:
    """dl_status rows from what each file(file, cell_id, minutes, cores, first, last, ranges, n, errors) brings."""
    cells = files.where("first is not null").groupBy("cell_id").agg(
        F.min("first").alias("dllog_start"), F.max("last").alias("dllog_end"), islands(F.flatten(F.collect_list("ranges"))).alias("dllog_ranges"), F.sum("n").alias("n_ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("errors")))).alias("dllog_errors"), F.sum("minutes").cast("int").alias("dltime"), F.sum(F.col("minutes") * F.col("cores")).cast("int").alias("dlcoremin"),
    )
    return _with_fixes(cells, start_date, stop_date, ignore)


def unresolved(old: Column, new: Column, covered_start: Column, covered_end: Column) -> Column:
    """Old errors that came again or that the new span doesn't cover, and new ones outside the old errors."""
    again = F.array_intersect(old, new)
    left = F.filter(old, lambda e: (e["start"] < covered_start) | (e["end"] > covered_end))
    return F.array_union(F.array_union(again, left), F.array_except(new, old))


def merge_status(old: DataFrame, new: DataFrame, start_date: str | None = None, stop_date: str | None = None, ignore: tuple[str, str] | None = None) -> DataFrame:
    """dl_status of both by cell: widest span, unresolved errors, runtimes added, and the gaps of all ranges together.  archivable: nothing is left to fix."""
    a, b = old.alias("a"), new.alias("b")
    none = F.expr(f"cast(array() as {_PAIRS})")
    j = a.join(b, F.col("a.cell_id") == F.col("b.cell_id"), "full")
    errors = unresolved(F.coalesce("a.dllog_errors", none), F.coalesce("b.dllog_errors", none), F.coalesce("b.dllog_start", F.lit("9999-12-31").cast("date")), F.coalesce("b.dllog_end", F.lit("0001-01-01").cast("date")))
    add = lambda c: (F.coalesce(f"a.{c}", F.lit(0)) + F.coalesce(f"b.{c}", F.lit(0))).alias(c)
    covered = islands(F.concat(F.coalesce("a.dllog_ranges", none), F.coalesce("b.dllog_ranges", none)))
    out = j.select(F.coalesce("a.cell_id", "b.cell_id").alias("cell_id"), F.least("a.dllog_start", "b.dllog_start").alias("dllog_start"), F.greatest("a.dllog_end", "b.dllog_end").alias("dllog_end"), covered.alias("dllog_ranges"), add("n_ranges"), errors.alias("dllog_errors"), add("dltime"), add("dlcoremin"))
    return _with_fixes(out, start_date, stop_date, ignore).withColumn("archivable", F.size("dl_fix_now") == 0)


def pending(status: DataFrame) -> DataFrame:
    return status.where(F.size("dl_fix_now") > 0)
