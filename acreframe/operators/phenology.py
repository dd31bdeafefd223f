"""Peaks, troughs and the measures of a growing season."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreframe.functions.numbers import ratio, short, whole_slope, wrapped_day
from acreframe.operators.features import KEY
from acreframe.operators.seasons import phenology_season

#: What stands for a value beyond the base, and for no value, among peaks and among troughs.
PEAK_MARK, PEAK_FILL, TROUGH_MARK, TROUGH_FILL = 1, 0, 10000, 32767
LOW = 2000
MEASURES = ("maxv", "minv", "amp", "med", "slp", "numrot", "posd", "posv", "numlow", "tosd", "tosv", "p1amp", "sosd", "sosv", "eosd", "eosv", "rog", "ros", "los")


def _days(d: str = "img_date") -> Column:
    return F.unix_date(F.col(d))


def _kept(value: Column, other: Column, before: Column | None, mark: int, sign: int) -> Column:
    """Whether a value is no less (sign 1: peaks) or no more (-1: troughs) than another; marks stay, as does what follows a mark at a wider step."""
    keep = (sign * (value - other) >= 0) | (value == mark)
    return keep | (before == mark) if before is not None else keep


def extremes(series: DataFrame, inside: Column, difference: int = 500, revise: bool = False) -> DataFrame:
    """series with `med` (of the rows inside, cut to 16 bits), `peak` and `trough` flags.

    A peak is no less than its neighbours among the values above the median and at least `difference` above it; a trough the same
    below.  Rows inside must be consecutive.  Ties count more than once.  revise compares at steps of 2 to 9 as well.
    """
    everything = Window.partitionBy(*KEY)
    line = everything.orderBy("img_date")
    out = series.withColumn("inside", inside).withColumn("med", short(F.median(F.when(F.col("inside"), F.col("value"))).over(everything)).cast("int"))
    v, med = F.col("value").cast("int"), F.col("med")
    out = out.withColumn("__p", F.when(F.col("inside"), F.when(v > med, v).otherwise(PEAK_MARK))).withColumn("__t", F.when(F.col("inside"), F.when(v < med, v).otherwise(TROUGH_MARK)))
    for step in range(1, 10 if revise else 2):
        for move in (F.lead, F.lag):
            changed = {}
            for name, mark, fill, sign in (("__p", PEAK_MARK, PEAK_FILL, 1), ("__t", TROUGH_MARK, TROUGH_FILL, -1)):
                value = F.col(name)
                other = F.coalesce(move(name, step).over(line), F.lit(fill))
                before = F.coalesce(move(name, step - 1).over(line), F.lit(fill)) if step > 1 else None
                changed[name] = F.when(value.isNotNull(), F.when(_kept(value, other, before, mark, sign), value).otherwise(fill))
            out = out.withColumns(changed)
    peak = F.coalesce(F.col("__p") >= med + difference, F.lit(False))
    trough = F.coalesce(F.col("__t") <= med - difference, F.lit(False))
    return out.withColumn("peak", peak).withColumn("trough", trough).drop("__p", "__t")


def peak_table(series: DataFrame, inside: Column, difference: int = 500) -> DataFrame:
    """Number, first and last date and value of peaks and troughs per pixel."""
    found = extremes(series, inside, difference).where("inside")
    columns = []
    for kind in ("peak", "trough"):
        d = F.when(F.col(kind), F.col("img_date"))
        columns += [F.count_if(kind).alias(f"n_{kind}"), F.min(d).alias(f"first_{kind}"), F.min_by("value", d).alias(f"first_{kind}_value"), F.max(d).alias(f"last_{kind}"), F.max_by("value", d).alias(f"last_{kind}_value")]
    return found.groupBy(*KEY).agg(*columns)


def simple_peak(series: DataFrame, threshold: int = 3000) -> DataFrame:
    """First date of the highest value among those of at least the threshold."""
    return series.groupBy(*KEY).agg(F.max_by("img_date", F.when(F.col("value") >= threshold, F.struct("value", -_days()))).alias("peak_date"))


def phenology_features(series: DataFrame, names: list[str], season: str, year: int, difference: int = 500, pad: tuple[int, int] = (20, 20), start: int = 305) -> DataFrame:
    """The measures asked for, as columns <name>_<season>, per pixel.

    Values are compared within the season; its start and end are looked for in the padded one.  Without a peak, posv is the
    median, and days, rates and length are 0.  Median and values are cut to 16 bits.  A pixel without a row in the season isn't
    returned.  One exchange on the pixel serves windows and aggregate.
    """
    unknown = [n for n in names if n not in MEASURES]
    if unknown:
        raise ValueError(f"unknown measures {unknown}")
    d = F.col("img_date")
    padded = phenology_season(season, d, year, pad, start)
    inside = phenology_season(season, d, year, (0, 0), start)
    flagged = extremes(series.where(padded | inside), inside, difference)
    everything = Window.partitionBy(*KEY)
    peak_date = F.when(F.col("peak"), d)
    seen = flagged.withColumn("first_peak", F.coalesce(F.min(peak_date).over(everything), F.max(F.when(F.col("inside"), d)).over(everything)))
    v, v_in, low = F.col("value").cast("int"), F.when(F.col("inside"), F.col("value").cast("int")), F.col("value") < LOW
    before, behind = d < F.col("first_peak"), d > F.col("first_peak")
    trough_date = F.when(F.col("trough"), d)
    aggregates = {
        "rows": F.count_if("inside"), "med": F.max("med"), "maxv": F.max(v_in), "minv": F.min(v_in),
        "slope": whole_slope(v_in, F.when(F.col("inside"), F.date_diff(d, F.make_date(F.lit(year), F.lit(1), F.lit(1))))),
        "peaks": F.count_if("peak"), "pos": F.min(peak_date), "pos_value": F.min_by(v, peak_date),
        "troughs": F.count_if("trough"), "tos": F.max(trough_date), "tos_value": F.max_by(v, trough_date),
        "sos": F.coalesce(F.max(F.when(before & low, d)), F.min(d)), "sos_value": F.coalesce(F.max_by(v, F.when(before & low, d)), F.min_by(v, d)),
        "eos": F.coalesce(F.min(F.when(behind & low, d)), F.max(d)), "eos_value": F.coalesce(F.min_by(v, F.when(behind & low, d)), F.max_by(v, d)),
    }
    g = seen.groupBy(*KEY).agg(*[x.alias(k) for k, x in aggregates.items()]).where("rows > 0")
    has, lows, med = F.col("peaks") > 0, F.col("troughs") > 0, F.col("med")
    posv = F.when(has, F.col("pos_value")).otherwise(med)
    tosv = F.when(lows, F.col("tos_value")).otherwise(med)
    day = {k: F.dayofyear(k) for k in ("pos", "tos", "sos", "eos")}
    posd = F.when(has, wrapped_day(day["pos"], start)).otherwise(0)
    tosd = F.when(lows, wrapped_day(day["tos"], start)).otherwise(0)
    sosd = F.when(has, wrapped_day(day["sos"], start - 40)).otherwise(0)
    eosd = F.when(has, wrapped_day(day["eos"], start)).otherwise(0)
    step = F.when(lows, F.when(has, posv - tosv).otherwise(med - tosv)).otherwise(posv - med)
    out = {
        "maxv": F.col("maxv"), "minv": F.col("minv"), "amp": F.col("maxv") - F.col("minv"), "med": med, "slp": short("slope"),
        "numrot": F.col("peaks"), "posd": posd, "posv": posv, "numlow": F.col("troughs"), "tosd": tosd, "tosv": tosv,
        "p1amp": F.when((step > 0) & (has | lows), step).otherwise(0), "sosd": sosd, "sosv": F.col("sos_value"), "eosd": eosd, "eosv": F.col("eos_value"),
        "rog": F.when(has, short(ratio(posv - F.col("sos_value"), posd - sosd))).otherwise(F.lit(0).cast("smallint")), "ros": F.when(has, short(ratio(posv - F.col("eos_value"), posd - eosd))).otherwise(F.lit(0).cast("smallint")),
        "los": F.when(has, eosd - sosd).otherwise(0),
    }
    return g.select(*KEY, *[out[n].alias(f"{n}_{season}") for n in names])


def derivative(series: DataFrame) -> DataFrame:
    """series with `deriv`, the slope per day: weighted differences to both neighbours, one-sided at the ends; null for a single row."""
    line = Window.partitionBy(*KEY).orderBy("img_date")
    t, v = _days().cast("double"), F.col("value").cast("double")
    hd, hs = t - F.lag(t).over(line), F.lead(t).over(line) - t
    left, right = ratio(v - F.lag(v).over(line), hd), ratio(F.lead(v).over(line) - v, hs)
    inner = ratio(left * hs + right * hd, hs + hd)
    return series.withColumn("deriv", F.coalesce(inner, right, left))


def derivative_peaks(series: DataFrame, peak: int, base: int) -> DataFrame:
    """First peak and number of peaks from changes of the derivative's sign; the simple peak where there is none.

    A maximum follows a rise, falls, and has a value of at least `peak`; a minimum the reverse, at most `base`.  The last seen of them
    is carried on (and the first one back): a maximum counts where that line steps by peak - base at least, or not at all.
    """
    line = Window.partitionBy(*KEY).orderBy("img_date")
    ahead = line.rowsBetween(Window.unboundedPreceding, 0)
    behind = line.rowsBetween(0, Window.unboundedFollowing)
    d = derivative(series).withColumn("last", F.lag("deriv").over(line))
    high = (F.col("deriv") < 0) & (F.col("last") > 0) & (F.col("value") >= peak)
    low = (F.col("deriv") > 0) & (F.col("last") < 0) & (F.col("value") <= base)
    d = d.withColumn("high", F.coalesce(high, F.lit(False))).withColumn("mark", F.when(high | low, F.col("value").cast("int")))
    d = d.withColumn("level", F.coalesce(F.last("mark", True).over(ahead), F.first("mark", True).over(behind)))
    step = F.col("level") - F.lag("level").over(line)
    true = F.col("high") & ((F.abs(step) >= peak - base) | (step == 0))
    d = d.withColumn("true", F.coalesce(true, F.lit(False)))
    simple = F.max_by("img_date", F.when(F.col("value") >= 3000, F.struct("value", -_days())))
    g = d.groupBy(*KEY).agg(F.count_if("true").alias("n"), F.min(F.when(F.col("true"), F.col("img_date"))).alias("first"), simple.alias("simple"))
    return g.select(*KEY, F.when(F.col("n") > 0, F.col("first")).otherwise(F.col("simple")).alias("peak_date"), F.when(F.col("n") > 0, F.col("n")).otherwise(F.when(F.col("simple").isNotNull(), 1).otherwise(0)).alias("n_peaks"))


def season_turn(series: DataFrame, peaks: DataFrame, method: str, side: str) -> DataFrame:
    """Start (side start) or end (side end) of a season around peak_date of each pixel: (key, turn_date, turn_value).

    thresh: nearest date below 2000; step: first date of a fall before the peak, or of a rise behind it; deriv: the date
    whose value is nearest to the median of the rising (falling) part.  Otherwise the first (last) row on that side; deriv gives null.
    """
    start = side == "start"
    part = series.join(peaks.select(*KEY, "peak_date"), list(KEY)).where((F.col("img_date") < F.col("peak_date")) if start else (F.col("img_date") > F.col("peak_date"))).drop("peak_date")
    line, everything = Window.partitionBy(*KEY).orderBy("img_date"), Window.partitionBy(*KEY)
    d = F.struct("img_date", "value")
    end = (F.min if start else F.max)(d)
    if method == "thresh":
        found = (F.max if start else F.min)(F.when(F.col("value") < LOW, d))
    elif method == "step":
        change = F.col("value") - F.lag("value").over(line)
        part = part.withColumn("turns", F.coalesce(change < 0 if start else change > 0, F.lit(False)))
        found = F.min(F.when(F.col("turns"), d))
    elif method == "deriv":
        part = derivative(part)
        part = part.where((F.col("deriv") > 0) if start else (F.col("deriv") < 0)).withColumn("off", F.abs(F.col("value") - F.median("value").over(everything)))
        found, end = F.min_by(d, F.struct("off", _days())), F.lit(None).cast(part.select(d.alias("d")).schema["d"].dataType)
    else:
        raise ValueError(f"unknown method {method}")
    turn = part.groupBy(*KEY).agg(F.coalesce(found, end).alias("t")).where("t is not null")
    return turn.select(*KEY, F.col("t.img_date").alias("turn_date"), F.col("t.value").alias("turn_value"))


def union_of_seasons(date: Column, year: int, pad: tuple[int, int]) -> Column:
    """Rows of either padded season, each once."""
    return reduce(lambda a, b: a | b, [phenology_season(s, date, year, pad) for s in ("wet", "dry")])
