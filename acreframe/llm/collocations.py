"""Phrases of several words that stand together more often than their parts would, counted in counting quotient filters."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acreframe.llm.common import bit_table, in_table, materialise, slices
from acreframe.llm.quotient_filter import Counted, decode, encode, permute, restore

#: Words that the dictionary numbers at most, as bits; phrases with other words are counted as text.
WORD_BITS = 20
#: Entries of a task's filter before it is handed on, places that are counted before they're merged with it, and words that a task counts.
HELD, PLACES, WORDS = 1 << 19, 1 << 20, 1 << 18
#: Ranges of permuted values in which filters are merged: a power of two, so many that one has about 2^20 of all places, within these bounds.
LEAST_RANGES, MOST_RANGES = 10, 16
#: Parts that a language's phrases are ranked in first.
PARTS = 256
#: Bytes of text that are split at a time; a piece is never cut.
SPLIT_BYTES = 1 << 20

#: A-Z in lower case, pieces end at any of .,;:!? and the line separators, words at blanks and tabs.
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """(lang, tokens) of some texts of a language; among the tokens are empty ones, and line ends between pieces."""
    for batch in batches:
        for part in slices(batch):
            by: dict[str, list[bytes]] = {}
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                data, at = b"\n".join(texts).translate(_TABLE), 0
                while at < len(data):
                    end = data.rfind(b"\n", at, at + SPLIT_BYTES) + 1 if at + SPLIT_BYTES < len(data) else len(data)
                    end = end or data.find(b"\n", at + SPLIT_BYTES) + 1 or len(data)
                    yield lang, data[at:end].replace(b"\n", b" \n ").split(b" ")
                    at = end


def word_counts(docs: DataFrame, least: int) -> DataFrame:
    """(lang, word, n) of the words that stand `least` times in a language; word null: all its words.  A task counts WORDS at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def rows() -> pa.RecordBatch:
            langs = [lang for lang, own in counts.items() for _ in range(len(own) + 1)]
            words = [w for own in counts.values() for w in (*own, None)]
            n = [n for own in counts.values() for n in (*own.values(), own.total())]
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], names=["lang", "word", "n"])

        for lang, tokens in _tokens(batches):
            own = counts.setdefault(lang, Counter())
            own.update(tokens)
            del own[b""], own[b"\n"]
            if sum(map(len, counts.values())) > WORDS:
                yield rows()
                counts.clear()
        if counts:
            yield rows()

    return _texts(docs).mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | F.col("word").isNull())


class Dictionary:
    """Numbers from 1 for the words of all languages that stand most often, 2^bits - 1 at most, and a filter of the other frequent words."""

    def __init__(self, words: DataFrame, bits: int):
        words = words.where("word is not null")
        ranked = words.orderBy(F.desc("n"), "lang", "word").limit((1 << bits) - 1).select("lang", "word").toArrow()
        self.bits, self.rest = bits, None
        self.names = list(zip(ranked.column("lang").to_pylist(), ranked.column("word").cast(pa.binary()).to_pylist(), strict=True))
        self.ids: dict[str, dict[bytes, int]] = {}
        for i, (lang, word) in enumerate(self.names, 1):
            self.ids.setdefault(lang, {b"": -2, b"\n": -1})[word] = i
        if len(self.names) == (1 << bits) - 1:
            rest = words.join(words.sparkSession.createDataFrame(ranked), ["lang", "word"], "left_anti")
            self.rest = bit_table(rest.select(F.xxhash64(F.concat_ws("\0", "lang", "word")).alias("h")))

    def numbers(self, lang: str, tokens: list[bytes]) -> np.ndarray:
        """The number of each token: 0 for a word that isn't numbered, -1 for the end of a piece, -2 for an empty one."""
        return np.fromiter(map(self.ids.get(lang, {b"": -2, b"\n": -1}).get, tokens, repeat(0)), np.int64, len(tokens))

    def frequent(self, lang: str, words: list[bytes]) -> np.ndarray:
        """Which words without a number may be frequent."""
        names = [xxhash.xxh64_intdigest(lang.encode() + b"\0" + w, 42) for w in words]
        return in_table(self.rest, np.array(names, np.uint64).view(np.int64))


def _numbered(ids: np.ndarray, size: int, known: Dictionary, allowed: np.ndarray | None) -> np.ndarray:
    """The permuted keys of the runs of `size` numbered words; both the words but the last and those but the first must be `allowed`."""
    many = max(0, len(ids) - size + 1)
    whole, keys = np.ones(many, bool), np.zeros(many, np.uint64)
    for k in range(size):
        whole &= ids[k : k + many] > 0
        keys = keys << np.uint64(known.bits) | np.maximum(ids[k : k + many], 0).astype(np.uint64)
    keys, width = keys[whole], known.bits * (size - 1)
    if allowed is not None:
        keys = keys[in_table(allowed, permute(keys >> np.uint64(known.bits), width).view(np.int64))]
        keys = keys[in_table(allowed, permute(keys & np.uint64((1 << width) - 1), width).view(np.int64))]
    return permute(keys, known.bits * size)


def _spelled(ids: np.ndarray, tokens: list[bytes], lang: str, size: int, known: Dictionary) -> Iterator[bytes]:
    """The runs of `size` words of which one at least has no number, and all may be frequent."""
    tokens, ids = [t for t in tokens if t], ids.copy()
    odd = np.flatnonzero(ids == 0)
    ids[odd[known.frequent(lang, [tokens[i] for i in odd.tolist()])]] = -3
    many = max(0, len(ids) - size + 1)
    runs = [ids[k : k + many] for k in range(size)]
    all_may = np.logical_and.reduce([(r > 0) | (r == -3) for r in runs])
    for i in np.flatnonzero(all_may & np.logical_or.reduce([r == -3 for r in runs])).tolist():
        yield b" ".join(tokens[i : i + size])


def phrase_counts(docs: DataFrame, known: Dictionary, size: int, least: int, places: int, shorter: DataFrame | None = None) -> DataFrame:
    """(lang, phrase, n, value) of the phrases of `size` words that stand `least` times; value is the permuted key, null where a word has no number.

    A task counts keys in a filter of up to HELD entries, and hands on what each range of values has of it.  A range's filters are merged
    as they come; what a task holds is the entries of one range.  `shorter`, counts of one word less, only keeps out phrases that can't be frequent.
    """
    spark, width = docs.sparkSession, known.bits * size
    ranges = min(width, MOST_RANGES, max(LEAST_RANGES, (places >> 20).bit_length()))
    allowed = None if shorter is None else spark.sparkContext.broadcast(bit_table(shorter.where("value is not null").select("value")))
    held = spark.sparkContext.broadcast(known)
    below = np.uint64(width - ranges)
    names = ["range", "filter", "lang", "phrase", "n"]

    def handed_on(found: Counted) -> pa.RecordBatch:
        cuts = np.searchsorted(found.values, np.arange((1 << ranges) + 1, dtype=np.uint64) << below) if width < 64 else None
        full = np.flatnonzero(np.diff(cuts))
        rest = found.values & np.uint64((1 << int(below)) - 1)
        blobs = [encode(Counted(rest[cuts[r] : cuts[r + 1]], found.counts[cuts[r] : cuts[r + 1]]), int(below)) for r in full]
        return pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(blobs, pa.binary()), *(pa.nulls(len(full), t) for t in (pa.string(), pa.string(), pa.int64()))], names=names)

    def as_text(counts: Counter) -> pa.RecordBatch:
        n = len(counts)
        langs, phrases = pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), langs, phrases, pa.array(list(counts.values()), pa.int64())], names=names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = held.value, None if allowed is None else allowed.value
        own, waiting, spelled = Counted.of(np.zeros(0, np.uint64)), [], Counter()
        for lang, tokens in _tokens(batches):
            ids = known.numbers(lang, tokens)
            ids = ids[ids != -2]
            waiting.append(_numbered(ids, size, known, table))
            if known.rest is not None:
                spelled.update((lang, p) for p in _spelled(ids, tokens, lang, size, known))
            if sum(map(len, waiting)) > PLACES:
                own, waiting = own.merged(Counted.of(np.concatenate(waiting))), []
            if len(own.values) > HELD:
                yield handed_on(own)
                own = Counted.of(np.zeros(0, np.uint64))
            if len(spelled) > WORDS:
                yield as_text(spelled)
                spelled = Counter()
        yield handed_on(own.merged(*[Counted.of(x) for x in waiting]))
        yield as_text(spelled)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of a task come by range."""
        names = held.value.names

        def frequent(at: int, parts: list[Counted]) -> pa.RecordBatch:
            found = parts[0].merged(*parts[1:])
            many = found.counts >= least
            values = found.values[many] | np.uint64(at) << below
            keys = restore(values, width)
            ids = [(keys >> np.uint64(known.bits * (size - 1 - k)) & np.uint64((1 << known.bits) - 1)).tolist() for k in range(size)]
            phrases = [b" ".join([names[i - 1][1] for i in run]) for run in zip(*ids, strict=True)]
            langs = [names[i - 1][0] for i in ids[0]]
            columns = [pa.array(langs, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(found.counts[many]), pa.array(values.view(np.int64))]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "n", "value"])

        at, parts, new = None, [], 0
        for batch in batches:
            for r, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if r != at and parts:
                    yield frequent(at, parts)
                    parts, new = [], 0
                at = r
                parts.append(decode(blob.as_py()))
                new += len(parts[-1].values)
                if new > max(PLACES, 2 * len(parts[0].values)):  # merged whenever it has grown by as much
                    parts, new = [parts[0].merged(*parts[1:])], 0
        if parts:
            yield frequent(at, parts)

    counted = materialise(_texts(docs).mapInArrow(count, "range long, filter binary, lang string, phrase string, n long"), "filters", compression="none")
    merged = counted.where("range is not null").select("range", "filter").repartition("range").sortWithinPartitions("range").mapInArrow(merge, "lang string, phrase string, n long, value long")
    spelled = counted.where("range is null").groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("lang", "phrase", "n", F.lit(None).cast("long").alias("value"))
    return merged.union(spelled)


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, first: int = 2000, bits: int = WORD_BITS) -> DataFrame:
    """The `first` phrases of each language of documents(lang, text) by score: lang, rank, phrase, a, l, r, n, score.

    A phrase of 2 to `longest` words that stands `a` times, `least` at least, scores floor(1000000 a a / (l r)) at the cut of its words where that is least
    (the first such cut); l and r are the counts of what the cut leaves.  It isn't returned if it lies in a longer phrase that stands in `share`
    percent of its places.  Ties: by a, then by phrase in byte order.  n counts all words of the language.  Null languages count as `und`, null texts as empty;
    repeated rows count as often as they come.  Other columns are ignored; an empty table gives an empty one.
    """
    if bits * longest > 63 or longest < 2:
        raise ValueError("phrases of two words at least, that 63 bits hold")
    words = materialise(word_counts(docs, least), "words")
    known = Dictionary(words, bits)
    totals = words.where("word is null").select("lang", F.col("n").alias("all"))
    places = totals.agg(F.sum("all")).first()[0] or 0
    counts = words.where("word is not null").select("lang", F.col("word").alias("phrase"), "n", F.lit(1).alias("size"))
    shorter = None
    for size in range(2, longest + 1):
        shorter = materialise(phrase_counts(docs, known, size, least, places, shorter), "phrases")
        counts = counts.union(shorter.select("lang", "phrase", "n", F.lit(size).alias("size")))
    return _ranked(_scored(_lasting(counts.where("size > 1"), share), counts, longest), first).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("all").alias("n"), "score")


def _lasting(phrases: DataFrame, share: int) -> DataFrame:
    """(lang, phrase, a, size), without the phrases that lie in a longer one which is frequent enough."""
    words = F.split("phrase", " ")
    part = lambda i, k: F.array_join(F.slice(words, i, k), " ")  # noqa: E731
    runs = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda k: F.transform(F.sequence(F.lit(1), F.col("size") - k + 1), lambda i: part(i, k))))
    inner = phrases.where("size > 2").select("lang", F.explode(F.array_distinct(runs)).alias("phrase"), F.col("n").alias("longer"))
    most = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    rows = phrases.join(most, ["lang", "phrase"], "left")
    return rows.where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("n"))).select("lang", "phrase", F.col("n").alias("a"), "size")


def _scored(phrases: DataFrame, counts: DataFrame, longest: int) -> DataFrame:
    """With l, r and score of the cut of the least score; products are decimals of up to 38 digits, divided as whole numbers."""
    words = F.split("phrase", " ")
    cut = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cut = cut.withColumns({"left": F.array_join(F.slice(words, F.lit(1), F.col("k")), " "), "right": F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ")})
    of = counts.where(F.col("size") < longest)
    cut = cut.join(of.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"]).join(of.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    whole = {c: f"cast({c} as decimal(15, 0))" for c in "alr"}
    score = F.expr(f"cast(1000000 as decimal(7, 0)) * ({whole['a']} * {whole['a']}) div ({whole['l']} * {whole['r']})")
    best = F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("best")
    return cut.withColumn("score", score).groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "best.*")


def _ranked(scored: DataFrame, first: int) -> DataFrame:
    """The first of each language: of the first of its parts, so a language's phrases never meet in one task."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    some = scored.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= first)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= first)


COLLOCATIONS_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-]')) as piece
  from documents
), w as (select lang, list_filter(string_split_regex(piece, '[ 	]'), lambda x: x <> '') as w from pieces),
runs as (
  select lang, 1 as size, unnest(w) as phrase from w
  union all select lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from w where len(w) > 1
  union all select lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) from w where len(w) > 2
), f as (select lang, size, phrase, count(*) as n from runs group by all),
totals as (select lang, sum(n) as n from f where size = 1 group by lang),
cand as (select lang, size, phrase, n as a, string_split(phrase, ' ') as w from f where size > 1 and n >= 10),
cuts as (
  select lang, size, phrase, a, w, k, array_to_string(w[:k], ' ') as lhs, array_to_string(w[k + 1:], ' ') as rhs from cand, (values (1), (2)) t(k) where k < size
), scored as (
  select c.lang, c.size, c.phrase, a, k, x.n as l, y.n as r, (1000000::hugeint * a * a) // (x.n::hugeint * y.n) as score
  from cuts c join f x on x.lang = c.lang and x.phrase = lhs join f y on y.lang = c.lang and y.phrase = rhs
), least as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inner_most as (
  select lang, phrase, max(a) as longer from (select lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) as phrase from cand where size = 3) group by all
), kept as (
  select s.* from least s left join inner_most i on i.lang = s.lang and i.phrase = s.phrase where longer is null or 100 * longer < 50 * a
)
select k.lang, row_number() over (partition by k.lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, t.n::bigint as n, score::bigint as score
from kept k join totals t on t.lang = k.lang
qualify rank <= 2000
"""
