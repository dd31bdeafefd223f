"""Benchmark decontamination: an FM-index for each shard of training text, searched for the windows of the test items."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreframe.llm.common import free_name, materialise, slices
from acreframe.llm.fm_index import FMIndex

#: Bytes that aren't part of a word become spaces, A-Z become a-z.
_FOLD = bytes(32 if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128) else c + 32 * (65 <= c <= 90) for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}

#: Text of a shard, test text of a block of queries, and test text that a pass over the documents holds.
SHARD_BYTES = 2 << 20
BLOCK_BYTES = 4 << 20
PASS_BYTES = 16 << 20


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


class Windows:
    """The distinct windows of a block of test items: phrases by length, and the items of each, as arrays."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int) -> None:
        ids: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = [ids.setdefault(w, len(ids)) for w in words_of(text)]
            for k in range(max(1, len(words) - window + 1) if words else 0):
                owners.setdefault(tuple(words[k : k + window]), set()).update([] if item is None else [item])
        self.vocabulary = list(ids)
        self.names = sorted({x for found in owners.values() for x in found})
        number = {x: i for i, x in enumerate(self.names)}
        by_length: dict[int, list[tuple[int, ...]]] = {}
        for phrase in sorted(owners):
            by_length.setdefault(len(phrase), []).append(phrase)
        self.groups = []
        for _, phrases in sorted(by_length.items()):
            many = np.array([len(owners[p]) for p in phrases])
            self.groups.append((np.array(phrases, np.int32), np.cumsum(many) - many, many, np.array([number[x] for p in phrases for x in sorted(owners[p])], np.int64)))


class Shard:
    """The FM-index of some texts, over all their words."""

    def __init__(self, texts: list[str | None]) -> None:
        self.vocabulary: dict[bytes, int] = {}
        ids: list[int] = []
        known, counts = self.vocabulary.setdefault, []
        for text in texts:
            words = words_of(text)
            counts.append(len(words))
            ids += [known(w, len(self.vocabulary) + 1) for w in words]
            ids.append(0)
        self.counts = np.array(counts, np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.counts + 1)))
        self.index = FMIndex(np.array(ids, np.int32))

    def find(self, windows: Windows, cover: np.ndarray, names: list[set[str]]) -> None:
        """Search a block of windows: adds to cover where hits begin and end, and to names the items of each text."""
        ids = np.array([self.vocabulary.get(w, 0) for w in windows.vocabulary], np.int32)
        for phrases, first, many, owners in windows.groups:
            mine = ids[phrases]
            known = np.flatnonzero((mine > 0).all(axis=1))
            if not len(known):
                continue
            lo, hi = self.index.search(mine[known])
            found = np.flatnonzero(hi > lo)
            times = hi[found] - lo[found]
            rows = np.repeat(lo[found], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            at = self.index.locate(rows)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + phrases.shape[1], -1)
            doc = np.searchsorted(self.starts, at, side="right") - 1
            for d, p in np.unique(np.stack((doc, np.repeat(known[found], times)), axis=1), axis=0).tolist():
                names[d].update(windows.names[x] for x in owners[first[p] : first[p] + many[p]])


def _marks(texts: list[str | None], blocks: list[Windows]) -> list[tuple[int, np.ndarray, set[str]]]:
    """For each text: its number of words, which of them are hit, and the items found.  The shard is indexed once, for all blocks."""
    shard, names = Shard(texts), [set() for _ in texts]
    cover = np.zeros(int(shard.starts[-1]) + 1, np.int64)
    for block in blocks:
        shard.find(block, cover, names)
    hit = np.cumsum(cover) > 0
    return [(n, hit[a : a + n], s) for n, a, s in zip(shard.counts.tolist(), shard.starts.tolist(), names, strict=False)]


def _without(text: str, runs: list[dict]) -> str:
    """The text without runs of hit words: from the first to the last word of each."""
    spans = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
    kept, at = [], 0
    for r in runs:
        kept.append(text[at : spans[r["start"]][0]])
        at = spans[r["end"] - 1][1]
    return "".join([*kept, text[at:]])


def _passes(benchmark: DataFrame) -> tuple[DataFrame, list[range]]:
    """Test items with the number of their block, and the blocks of each pass over the documents; the size is taken before anything is collected."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n, each = max(1, -(-size // BLOCK_BYTES)), max(1, PASS_BYTES // BLOCK_BYTES)
    return items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n))), [range(at, min(n, at + each)) for at in range(0, n, each)]


def marked(docs: DataFrame, benchmark: DataFrame, window: int = 10, cut: bool = False) -> tuple[DataFrame, str, str, str]:
    """docs with three more columns, and their names: words of the text, runs (start, end) of hit ones, and the items found (sorted).

    cut: the hit runs are cut out of text besides, once all items are searched, and n_chars, where there is one, follows.  Each slice of a
    partition is a shard with an index of its own, which all blocks of a pass are searched in; nothing is shuffled.  A benchmark
    of up to PASS_BYTES of text takes one pass.  A larger one takes several, each with a broadcast that is freed behind it, and between
    them the documents are written with what was found so far.
    """
    words, runs, items = (free_name(docs, x) for x in ("__words", "__runs", "__items"))
    spark, names = docs.sparkSession, docs.columns
    state = ((words, "long"), (runs, "array<struct<start:bigint,end:bigint>>"), (items, "array<string>"))
    out = docs.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in state])
    types = (pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.string()))

    def search(held: Broadcast, clean: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, size=SHARD_BYTES):
                    texts, found = part.column("text").to_pylist(), []
                    for (n, hit, own), old, known in zip(_marks(texts, held.value), part.column(runs).to_pylist(), part.column(items).to_pylist(), strict=True):
                        for r in old or []:
                            hit[r["start"] : r["end"]] = True
                        edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
                        spans = zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)
                        found.append((n, [{"start": a, "end": b} for a, b in spans], sorted(own.union(known or []))))
                    given = {x: part.column(x) for x in names}
                    if clean:
                        texts = [_without(t, r) if r else t for t, (_, r, _) in zip(texts, found, strict=True)]
                        given["text"] = pa.array(texts, pa.string())
                        if "n_chars" in given:
                            given["n_chars"] = pa.array([None if t is None else len(t) for t in texts], part.column("n_chars").type)
                    columns = [pa.array(x, t) for x, t in zip(zip(*found, strict=True), types, strict=True)]
                    yield pa.RecordBatch.from_arrays([*given.values(), *columns], names=[*names, words, runs, items])

        return run

    given, passes = _passes(benchmark)
    last = None
    for k, blocks in enumerate(passes):
        if last is not None:
            out = materialise(out, "marked")
            last.destroy()
        last = spark.sparkContext.broadcast([Windows([tuple(r) for r in given.where(F.col("block") == b).select("item", "text").collect()], window) for b in blocks])
        out = out.mapInArrow(search(last, cut and k == len(passes) - 1), out.schema)
    return out, words, runs, items


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Which words of documents(doc_id, text) lie in a window of benchmark(item_id, text).

    A window is `window` consecutive words of an item, or all words of a shorter one.  The items are a stated query set,
    searched in blocks against all rows (see marked).  Returns doc_id, n_words, n_hit, n_items, items_sha256 (of the sorted ids,
    comma-joined; of nothing where none is found) and contaminated.  A null or empty text has no words; null ids are returned as they
    are, and an item without an id marks words but isn't counted.  Repeated rows each get their row; other columns are ignored.
    """
    found, words, runs, items = marked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), benchmark, window)
    hits = F.aggregate(runs, F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    found = found.select("doc_id", F.col(words).alias("n_words"), hits.alias("n_hit"), F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"))
    return found.withColumn("contaminated", F.col("n_hit") > 0)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """docs, all rows and columns, with the spans of words that lie in a window of the benchmark cut out of text; n_chars, where there is one, follows."""
    return marked(docs, benchmark, window, cut=True)[0].select(docs.columns)


CONTAMINATION_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
k AS (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS k FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, list_slice(w, k, k + 9) AS v, len(list_slice(w, k, k + 9)) AS n FROM k),
pos AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM win) s WHERE len(w) >= n),
m AS (SELECT doc_id, item_id, p, pos.n FROM pos JOIN win ON pos.n = win.n AND list_slice(w, p, p + pos.n - 1) = v),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM m) GROUP BY 1),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM m) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN i ON d.doc_id = i.doc_id
"""
