"""Near copies by the share of word shingles two texts have in common: every pair from the given similarity on is linked.

Covering hashing of SimHash fingerprints finds groups first, whose members are compared with a pivot each.  Fingerprints bound no
similarity, so a join of the sets' prefixes finds the pairs that are still apart: none from the given similarity on is missed.  Where many
sets share a shingle of their prefixes, they are compared with one of them, then those still apart meet once a pair if sketches of them allow it
(see `_may_be_similar`).  Where very many share one, they are told by what sets them apart from one of them, and these differences are joined (see `_differences`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreframe.llm.common import bit_table, digest, in_table, materialise, row_key, slices
from acreframe.llm.components import components
from acreframe.llm.simhash import keep_first, links, majority

#: One of SAMPLE texts is looked at for common shingles, which stand in COMMON of those at least.  This only orders shingles; it drops none.
SAMPLE, COMMON = 16, 3
#: Sets that share a shingle of their prefixes all meet up to CROWDED.  Beyond that they're compared with a pivot, and meet by sketches up to DENSE.  Beyond
#: that they're told by their differences from a pivot, and so are those that share a difference, LEVELS times; whatever is crowded then is compared pair by pair.
CROWDED, DENSE, LEVELS = 16, 1024, 2
#: Bits of a set's sketch.
SKETCH = 1024
#: Sets far from a pivot that are compared with each other; more of them get another pivot.
FAR = 256
#: Bits in which fingerprints of a covering group differ from one to the next.
RADIUS = 3

_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, length: int = 5) -> np.ndarray:
    """The distinct hashes of the runs of `length` words, sorted; one of all words where there are fewer, and zero where there is none."""
    words = (text or "").encode().lower().split()
    digests = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out = np.zeros(max(1, len(words) - length + 1), np.uint64)
    for k in range(min(length, len(words))):
        out = out * _ODD + digests[k : k + len(out)]
    out ^= out >> np.uint64(32)
    out *= _ODD
    return np.unique(out ^ out >> np.uint64(29))


def _sketch(shingles: np.ndarray) -> np.ndarray:
    """SKETCH bits: whether the shingles of each remainder are odd in number.  A shingle that only one of two sets has changes one bit."""
    odd = np.bincount((shingles % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _name(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes(), 42) - (1 << 63)


def _common(docs: DataFrame, length: int) -> DataFrame:
    """(h): shingles that several texts of the sample have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = np.concatenate([shingle_set(t, length) for t in part.column(0).to_pylist()])
                h, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

    texts = docs.select(F.col("text").cast("string").alias("text")).where(f"pmod(xxhash64(text), {SAMPLE}) = 0").distinct()
    return texts.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON).select("h")


def _prints(docs: DataFrame, held: Broadcast, length: int, percent: int) -> DataFrame:
    """(key, digest, doc_id, id, fp, n, bits, prefix) of each row: id names its shingle set of n, fp is its fingerprint, bits its sketch; prefix: its first shingles, common ones ordered last.

    Sets of a similarity of `percent` share percent of the larger one at least, so in any one order of all shingles, the first
    n - ceil(percent n) + 1 of each can't be disjoint.  held: a filter of the common ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                ids, prints, many, bits, first = [], [], [], [], []
                for text in part.column("text").to_pylist():
                    own = shingle_set(text, length)
                    late = in_table(held.value, own)
                    ids.append(_name(own))
                    prints.append(majority(own))
                    many.append(len(own))
                    bits.append(_sketch(own))
                    first.append(np.concatenate((own[~late], own[late]))[: len(own) - -(-percent * len(own) // 100) + 1].view(np.int64))
                columns = [*part.columns[:3], pa.array(ids, pa.int64()), pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(many, pa.int64()), *(pa.array(x, pa.list_(pa.int64())) for x in (bits, first))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "digest", "doc_id", "id", "fp", "n", "bits", "prefix"])

    rows = docs.select(row_key().alias("key"), digest().alias("digest"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "key long, digest binary, doc_id long, id long, fp long, n long, bits array<long>, prefix array<long>")


def _buckets(prints: DataFrame) -> DataFrame:
    """(h, id, n, i): the shingles of prefixes that several sets have there, and at which place from 0."""
    dealt = prints.select("id", "n", F.posexplode("prefix").alias("i", "h")).repartition("h")
    shared = dealt.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo != hi").select("h")
    return dealt.join(shared.hint("merge"), "h", "left_semi").select("h", "id", "n", "i").distinct()


def _common_least(n: str, n2: str, percent: int) -> Column:
    """How many shingles similar sets of n and n2 have in common at least."""
    return F.ceil(percent * (F.col(n) + F.col(n2)) / (100 + percent) - F.lit(1e-6))


def _placed(crowded: DataFrame, percent: int) -> DataFrame:
    """The rows of crowded buckets (h, id, n, i, ...) by which similar sets can meet first.

    What they share lies from the first shared shingle on, so of either set that many are left there.  For the smaller one this ends its prefix at
    half the length; so a row lies there (ahead), or is of a set larger than one that does.
    """
    marked = crowded.withColumn("__ahead", F.col("i") + _common_least("n", "n", percent) <= F.col("n"))
    least = marked.where("__ahead").groupBy("h").agg(F.min("n").alias("__n"), F.count("*").alias("__many"))
    return marked.join(least, "h").where((F.col("__ahead") & (F.col("__many") > 1)) | (F.col("n") >= F.col("__n"))).drop("__ahead", "__n", "__many")


def _least_shared(percent: int) -> Column:
    """How many shingles of their prefixes sets of n and n2 share at least if they're similar.

    Similar sets of n and m share percent (n + m) / (100 + percent) at least, so of either prefix all but n (m) less that many are in the
    other set; of the prefix that ends first in the order, these are in the other prefix.
    """
    prefix = lambda n: F.floor((100 - percent) * F.col(n) / 100) + 1
    common = _common_least("n", "n2", percent)
    return F.least(prefix("n") - F.col("n") + common, prefix("n2") - F.col("n2") + common)


def _may_be_similar(percent: int) -> Column:
    """Whether sets of n and n2 with sketches bits and bits2 may be similar: sketches differ in no more bits than the sets do in shingles."""
    words = [F.bit_count(F.get("bits", F.lit(k)).bitwiseXOR(F.get("bits2", F.lit(k)))) for k in range(SKETCH // 64)]
    return sum(words[1:], words[0]) <= F.col("n") + F.col("n2") - 2 * _common_least("n", "n2", percent)


def _met_once(rows: DataFrame, percent: int) -> DataFrame:
    """(u, v) of the sets of rows (h, id, n, i, k, bits, label) that have unlike labels, share an h and may be similar.

    Each pair meets once: at the first shingle that both have among these rows, so where nothing that stands before it is in both.
    """
    before = F.collect_list("h").over(Window.partitionBy("id").orderBy("i").rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.withColumn("before", before)
    common = _common_least("n", "n2", percent)
    sized = (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")) & (F.least("k", "k2") >= _least_shared(percent))
    ahead = (F.col("i") + common <= F.col("n")) & (F.col("i2") + common <= F.col("n2"))
    met = placed.join(_second(placed), "h").where(F.expr("id > id2 and label != label2") & sized & ahead & _may_be_similar(percent) & ~F.arrays_overlap("before", "before2"))
    return met.select(F.col("id").alias("u"), F.col("id2").alias("v"))


def _to_pivots(rows: DataFrame, percent: int) -> DataFrame:
    """(u, v): the sets of rows (h, id, n, i, k, bits, label) with the pivot of each bucket they lie in, if they have unlike labels and may be similar.

    The pivot is the set with most crowded shingles, so buckets whose sets meet otherwise have the same one if it's in both.
    """
    pivots = rows.groupBy("h").agg(F.min_by(F.struct("id", "n", "bits", "label"), F.struct(-F.col("k"), F.xxhash64("id"))).alias("p")).select("h", "p.*")
    return _pairs(rows.join(_second(pivots), "h").where("label != label2").where(_may_be_similar(percent)).drop("i", "k"), percent)


def _pairs(met: DataFrame, percent: int) -> DataFrame:
    """(u, v) of (id, n, id2, n2), each once; sets too unlike in size can't be similar.

    Where k and k2 say how many crowded shingles the prefixes hold, neither are sets that can't share enough of them; if
    they share others besides, they meet in buckets of few.  Where i and i2 are the places of what they share, it may be the first such shingle.
    """
    sized = met.where("id != id2").where(100 * F.least("n", "n2") >= percent * F.greatest("n", "n2"))
    if "k" in met.columns:
        sized = sized.where(F.least("k", "k2") >= _least_shared(percent))
    if "i" in met.columns:
        common = _common_least("n", "n2", percent)
        sized = sized.where((F.col("i") + common <= F.col("n")) & (F.col("i2") + common <= F.col("n2")))
    return sized.select(F.greatest("id", "id2").alias("u"), F.least("id", "id2").alias("v")).distinct()


def _likely(few: DataFrame, many: DataFrame, percent: int) -> DataFrame:
    """(u, v) of the sets of unlike labels that meet in buckets of few, without those that share too few shingles of their prefixes to be similar.

    Shared crowded shingles aren't counted one by one: the lesser number of them in either prefix, of (id, k), stands for them.
    """
    met = few.join(_second(few), "h").where("id > id2 and label != label2").where(100 * F.least("n", "n2") >= percent * F.greatest("n", "n2"))
    shared = met.groupBy(F.col("id").alias("u"), F.col("id2").alias("v")).agg(F.count("*").alias("c"), F.first("n").alias("n"), F.first("n2").alias("n2"))
    shared = shared.join(many.toDF("u", "k"), "u", "left").join(many.toDF("v", "k2"), "v", "left").na.fill(0, ["k", "k2"])
    return shared.where(F.col("c") + F.least("k", "k2") >= _least_shared(percent)).select("u", "v")


def _second(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed({c: f"{c}2" for c in rows.columns if c != "h"})


def _own_texts(docs: DataFrame, prints: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(id, text): a text of each wanted set."""
    keys = prints.join(wanted, "id", "left_semi").groupBy("id").agg(F.min("key").alias("key")).select("key")
    held = docs.sparkSession.sparkContext.broadcast(bit_table(keys))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(in_table(held.value, batch.column(0).to_numpy())))
            for part in slices(batch):
                names = [_name(shingle_set(t, length)) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), part.column(1)], names=["id", "text"])

    own = docs.select(row_key().alias("key"), F.col("text").cast("string").alias("text")).mapInArrow(texts, "id long, text string")
    return own.join(wanted, "id", "left_semi").dropDuplicates(["id"])


def _similar(docs: DataFrame, prints: DataFrame, pairs: DataFrame, length: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose shingle sets are similar, compared whole."""
    pairs = materialise(pairs, "pairs")
    if pairs.isEmpty():
        return pairs

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            right, one, x = [], None, None
            for u, a, b in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                one, x = (one, x) if u == one else (u, shingle_set(a.as_py(), length))
                y = shingle_set(b.as_py(), length)
                right.append((100 + percent) * len(np.intersect1d(x, y, assume_unique=True)) >= percent * (len(x) + len(y)))
            yield batch.select(["u", "v"]).filter(pa.array(right, pa.bool_()))

    own = _own_texts(docs, prints, pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct(), length)
    both = pairs.join(own.select(F.col("id").alias("u"), F.col("text").alias("a")), "u").join(own.select(F.col("id").alias("v"), F.col("text").alias("b")), "v")
    return materialise(both.select("u", "v", "a", "b").mapInArrow(compare, "u long, v long"), "similar")


def _differences(docs: DataFrame, prints: DataFrame, pairs: DataFrame, held: Broadcast, length: int, percent: int) -> DataFrame:
    """(p, id, linked, far, d, w, first, rest) of pairs (p, id): how the set of id differs from that of its pivot p.

    Of a set S, let A be what it has beside the pivot P and R what it lacks of it, D both together, d = |D| and w = percent |A| + 100 |R|.
    S is similar to P (linked) if w <= (100 - percent) |P| = c; and S1 to S2 if (100 + percent) |D1 & D2| >= w1 + w2 - c, for |S1 & S2| is
    |P| - |R1| - |R2| + |D1 & D2|.  So sets that are similar to each other but not both to the pivot share a difference at least, and more than
    w1 / (100 + percent) of them if S2 isn't linked; two that aren't share (w1 - c) / 100 at least.  In any one order of all differences the first
    d - least + 1 of each can't be disjoint: `first` are those for a set that isn't linked to meet others like it, or for a linked one to meet those that
    aren't, `rest` the further ones by which a set that isn't linked meets linked ones.  Common shingles (of the filter `held`) come after others, and what
    is lacking comes last: many lack the same.

    One less the similarity is a distance, so similar sets lie about as far from the pivot.  Sets further off than three times the distance of similar ones have no
    differences listed, for these are most of the set; such a set can only be similar to one that is `far`: further off than two times that distance.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, one, pivot = [], None, None
            for p, i, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                one, pivot = (one, pivot) if p == one else (p, shingle_set(b.as_py(), length))
                own = shingle_set(a.as_py(), length)
                added, lacking = np.setdiff1d(own, pivot, assume_unique=True), np.setdiff1d(pivot, own, assume_unique=True)
                d, w, c = len(added) + len(lacking), percent * len(added) + 100 * len(lacking), (100 - percent) * len(pivot)
                linked = w <= c
                least = w // (100 + percent) + 1 if linked else max(w // (100 + percent) + 1, -(-(w - c) // 100))
                by_linked = -(-(w - c) // (100 + percent))  # and a linked set has at most c / percent differences
                both, every = len(own) - len(added), len(pivot) + len(added)
                far = 100 * both < (2 * percent - 100) * every
                first = max(0, d - least + 1) if 100 * both >= (3 * percent - 200) * every else 0
                last = first if linked or not first or by_linked * percent > c else max(first, d - by_linked + 1)
                late = in_table(held.value, added)
                order = np.concatenate((added[~late], added[late], lacking)).view(np.int64)
                out.append((p, i, linked, far, d, w, order[:first], order[first:last]))
            types = {"p": pa.int64(), "id": pa.int64(), "linked": pa.bool_(), "far": pa.bool_(), "d": pa.int64(), "w": pa.int64(), "first": pa.list_(pa.int64()), "rest": pa.list_(pa.int64())}
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types.values())], names=list(types))

    own = _own_texts(docs, prints, pairs.select("id").union(pairs.select("p")).distinct(), length)
    # the pivots' texts, of which each meets many, are joined last and not moved again
    both = pairs.join(own.select("id", F.col("text").alias("a")), "id").join(own.select(F.col("id").alias("p"), F.col("text").alias("b")), "p")
    return both.select("p", "id", "a", "b").mapInArrow(compare, "p long, id long, linked boolean, far boolean, d long, w long, first array<long>, rest array<long>")


def _covered(prints: DataFrame, percent: int) -> DataFrame:
    """(u, v): each set of a covering group of fingerprints with the group's pivot."""
    sets = prints.select("id", "n", "fp").distinct()
    roots = components(links(sets.select("fp").distinct(), RADIUS)).withColumnRenamed("node", "fp")
    grouped = sets.join(roots, "fp", "left").select("id", "n", F.coalesce("root", "fp").alias("h"))
    pivots = grouped.groupBy("h").agg(F.min_by(F.struct("id", "n"), F.xxhash64("id")).alias("p"), F.count("*").alias("many")).where("many > 1").select("h", "p.*")
    return _pairs(grouped.join(_second(pivots), "h"), percent)


def _labelled(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of sets with a label that is the same for sets of one root (node, root)."""
    return rows.join(roots.withColumnRenamed("node", "id"), "id", "left").select(*rows.columns, F.coalesce("root", "id").alias("label"))


def _stars(roots: DataFrame) -> DataFrame:
    """Edges (u, v) that connect what (node, root) does: components of these and a few more settle in few rounds."""
    return roots.where("node != root").select(F.col("node").alias("u"), F.col("root").alias("v"))


def _connected(roots: DataFrame, more: DataFrame) -> DataFrame:
    """(node, root) with more edges (u, v)."""
    return roots if more.isEmpty() else components(_stars(roots).union(more))


def _apart(rows: DataFrame) -> DataFrame:
    """Rows (h, label, ...) of the buckets that hold sets of several labels."""
    several = rows.groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("h")
    return rows.join(several, "h", "left_semi")


def _by_size(crowded: DataFrame) -> DataFrame:
    """Buckets split by size, so that no set in one is over 1.6 times as large as another: sizes go by steps of 5/4, and each set lies with the sets
    of its own step and the one below, and with those of its own and the one above."""
    step = F.floor(F.log("n") / float(np.log(1.25)) + 1e-9)
    return crowded.withColumn("__step", F.explode(F.array(step, step + 1))).withColumn("h", F.xxhash64("h", "__step")).drop("__step")


def _met(parts: DataFrame, percent: int) -> DataFrame:
    """(u, v) of the sets of unlike labels that share a difference by which similar ones must meet; c is (100 - percent) |P|."""
    ways = (F.col("linked") != F.col("linked2")) | (~F.col("linked") & ~F.col("linked2") & F.col("first") & F.col("first2"))
    many = F.col("w") + F.col("w2") - F.col("c") <= (100 + percent) * F.least("d", "d2")
    return _pairs(parts.join(_second(parts), "h").where("id > id2 and label != label2").where(ways & many), percent)


def _split(docs: DataFrame, prints: DataFrame, crowded: DataFrame, roots: DataFrame, held: Broadcast, length: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Compare crowded buckets (h, id, n, k) with a pivot each: the roots with more edges, and the buckets that are crowded again, of differences or of sets far from a pivot.

    Buckets whose sets meet otherwise have the same pivot if it's in both, so a set is compared with few pivots.
    """
    pivots = crowded.groupBy("h").agg(F.min_by(F.struct("id", "n"), F.struct(-F.col("k"), F.xxhash64("id"))).alias("p")).select("h", F.col("p.id").alias("p"), F.col("p.n").alias("np"))
    to = materialise(crowded.join(pivots, "h").where("id != p").select("p", "np", "id", "n", "k").distinct(), "pivots")
    found = materialise(_differences(docs, prints, to.select("p", "id"), held, length, percent), "differences")
    roots = _connected(roots, found.where("linked").select(F.greatest("id", "p").alias("u"), F.least("id", "p").alias("v")))
    labels = _labelled(to.select("id", "n", "k").distinct(), roots)
    own = lambda c: F.transform(c, lambda e: F.struct(e.alias("e"), F.lit(c == "first").alias("first")))
    # sizes and labels are joined before differences are listed one by one
    sized = to.select("p", "id", "n", "k", (100 - percent) * F.col("np")).toDF("p", "id", "n", "k", "c")
    known = found.join(sized, ["p", "id"]).join(labels.select("id", "label"), "id").withColumn("at", F.explode(F.concat(own("first"), own("rest"))))
    parts = known.select(F.xxhash64("p", "at.e").alias("h"), "id", "n", "k", "c", "linked", "at.first", "d", "w", "label")
    # a bucket can hold a pair if its labels differ, and two sets that aren't linked have it among the first, or one that is and one that isn't share it
    sizes = parts.groupBy("h").agg(F.count("*").alias("many"), F.count_if(~F.col("linked") & F.col("first")).alias("free"), F.count_if("linked").alias("bound"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    sizes = sizes.where("lo != hi").where((F.col("free") > 1) | ((F.col("bound") > 0) & (F.col("bound") < F.col("many")))).select("h", "many")
    parts = materialise(parts.join(sizes, "h"), "parts")
    # those far from a pivot, by pivot; many of them get another one
    off = found.where("far").join(to.drop("np"), ["p", "id"]).join(labels.select("id", "label"), "id")
    sizes = off.groupBy("p").agg(F.count("*").alias("many")).where("many > 1")
    off = materialise(_apart(off.join(sizes, "p").select(F.xxhash64("p", F.lit("far")).alias("h"), "id", "n", "k", "label", "many")), "far")
    few = off.where(F.col("many") <= FAR).select("h", "id", "n", "k", "label")
    pairs = _met(parts.where(F.col("many") <= CROWDED).drop("many"), percent).union(_pairs(few.join(_second(few), "h").where("id > id2 and label != label2"), percent)).distinct()
    roots = _connected(roots, _similar(docs, prints, pairs, length, percent))
    again = parts.where(F.col("many") > CROWDED).select("h", "id", "n", "k").union(off.where(F.col("many") > FAR).select("h", "id", "n", "k"))
    return roots, again.distinct()


def similar_links(docs: DataFrame, prints: DataFrame, held: Broadcast, length: int = 5, percent: int = 80) -> DataFrame:
    """Edges (u, v) that connect the set ids of prints as all pairs of a similarity of `percent` do.

    Pairs of sets that are linked already needn't be compared.  So each set is first compared with the pivots of its covering group and of its crowded buckets.  Crowded
    buckets that still hold sets apart are joined by sketches, very large ones split by differences from a pivot, then the pairs in buckets of few are compared.
    """
    buckets = materialise(_buckets(prints), "buckets")
    crowds = buckets.groupBy("h").agg(F.count("*").alias("many")).where(F.col("many") > CROWDED).select("h")
    met = materialise(buckets.join(crowds, "h", "left_semi"), "met")
    many = materialise(met.groupBy("id").agg(F.count("*").alias("k")), "many")
    counted = met.join(many, "id").select("h", "id", "n", "i", "k")
    sketches = prints.groupBy("id").agg(F.first("bits").alias("bits"))
    crowded = materialise(_placed(counted, percent).join(sketches, "id"), "crowded")
    few = buckets.join(crowds, "h", "left_anti").drop("i")
    roots = components(_similar(docs, prints, _covered(prints, percent), length, percent))
    rows = materialise(_apart(_labelled(crowded, roots)), "labels")
    roots = _connected(roots, _similar(docs, prints, _to_pivots(rows, percent), length, percent))
    rows = materialise(_apart(_labelled(rows.drop("label"), roots)), "labels")
    large = materialise(rows.groupBy("h").agg(F.count("*").alias("many")).where(F.col("many") > DENSE).select("h"), "large")
    roots = _connected(roots, _similar(docs, prints, _met_once(rows.join(large, "h", "left_anti"), percent), length, percent))
    crowded = rows.join(large, "h", "left_semi").drop("bits", "label")
    open_ = _by_size(crowded)
    for _ in range(LEVELS):
        open_ = materialise(_apart(_labelled(open_, roots)).select("h", "id", "n", "k"), "apart")
        if open_.isEmpty():
            break
        roots, open_ = _split(docs, prints, open_, roots, held, length, percent)
    else:
        # whoever is still crowded meets in the buckets of the beginning, of which there are fewer for a pair than of differences
        left = crowded.join(open_.select("id").distinct(), "id", "left_semi")
        rows = materialise(_apart(_labelled(left, roots)), "labels")
        roots = _connected(roots, _similar(docs, prints, _pairs(rows.join(_second(rows), "h").where("id > id2 and label != label2"), percent), length, percent))
    return _stars(roots).union(_similar(docs, prints, _likely(materialise(_labelled(few, roots), "labels"), many, percent), length, percent))


def similar_groups(docs: DataFrame, length: int = 5, percent: int = 80) -> DataFrame:
    """Group documents(doc_id, text) whose sets of word shingles are linked by steps of a Jaccard similarity of `percent` at least.

    Returns key, digest, doc_id, group and component_id, the least doc_id of the group.  Texts of equal sets are merged first; null and
    empty texts have the same set.  A row without doc_id never names its group unless all its group's ids are null (then null).
    """
    held = docs.sparkSession.sparkContext.broadcast(bit_table(_common(docs, length)))
    prints = materialise(_prints(docs, held, length, percent), "prints")
    roots = materialise(components(similar_links(docs, prints, held, length, percent)), "roots").withColumnRenamed("node", "id")
    least = prints.groupBy("id").agg(F.min("doc_id").alias("least"))
    named = least.join(roots, "id", "left").select("id", "least", F.coalesce("root", "id").alias("group"))
    of = materialise(named.join(named.groupBy("group").agg(F.min("least").alias("component_id")), "group").select("id", "group", "component_id"), "groups")
    return prints.select("key", "digest", "doc_id", "id").join(of, "id").select("key", "digest", "doc_id", "group", "component_id")


def drop_similar(docs: DataFrame, length: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, all columns, whose doc_id names its group of similar texts; as drop_near_copies otherwise."""
    return keep_first(docs, similar_groups(docs, length, percent), "group")
