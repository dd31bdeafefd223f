"""Information-theoretic sanitisation: terms whose co-occurrence with a protected entity gives it away are generalised or removed."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreframe.llm.common import bit_table, digest, free_name, in_table, materialise, row_key, slices

KINDS = ("email", "ip", "card", "phone", "generalise", "remove")
#: A term is seen with a single value where it stands within so many words of it; with a kind of value, anywhere in the text.
BESIDE_WORDS = 8
#: Texts in which a term and an entity must be seen together, texts that the entity's own rate counts as beside those, and the
#: shares of the entity's information from which a term is generalised and removed.
SUPPORT, PRIOR, GENERALISE, REMOVE = 3, 3, 0.7, 0.9
#: Distinct terms whose counts a task holds.
HELD_TERMS = 200_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")  # a run without dots too, so that a long one is read once
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")
_SIGN = re.compile("[0-9@]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at sign leftwards, so a long run without one isn't read again and again."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four parts at a time of each run of dotted numbers."""
    for run in _DOTTED.finditer(text):
        parts, at = run[0].split("."), run.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in four):
                yield at, end
            at = end + 1


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, number of the kind, end, value) of the entities that patterns find, in order; each has a digit or an at sign."""
    if not _SIGN.search(text):
        return []
    out = [(a, 0, b, text[a:b].lower()) for a, b in _emails(text)]
    out += [(a, 1, b, text[a:b]) for a, b in _addresses(text)]
    for kind, pattern, least, most in ((2, _CARD, 12, 19), (3, _PHONE, 9, 15)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if least <= len(digits) <= most and (kind == 3 or _luhn(digits)):
                out.append((m.start(), kind, m.end(), digits))
    return sorted(out)


def _entity(kind: int, value: str = "") -> int:
    """The number of a value, or of all values of a kind."""
    return xxhash.xxh64_intdigest(f"{KINDS[kind]}:{value}", 42) - (1 << 63)


def _terms(text: str, spans: list[tuple[int, int, int, str]]) -> list[tuple[str, int, int]]:
    """The terms outside the spans, in lower case, and where they stand."""
    out, at = [], 0
    for a, _, b, _ in [*spans, (len(text), 0, len(text), "")]:
        out += [(m[0].lower(), *m.span()) for m in _TERM.finditer(text, at, max(a, at))]
        at = max(at, b)
    return out


def _beside(terms: list[tuple[str, int, int]], spans: list[tuple[int, int, int, str]]) -> set[tuple[int, str]]:
    """(value, term) of the terms that stand near each value."""
    starts = np.array([a for _, a, _ in terms], np.int64)
    out = set()
    for a, kind, _, value in spans:
        at = int(np.searchsorted(starts, a))
        out |= {(_entity(kind, value), t) for t, *_ in terms[max(0, at - BESIDE_WORDS) : at + BESIDE_WORDS]}
    return out


_FOUND = pa.schema(
    [
        ("key", pa.int64()),
        ("doc_id", pa.int64()),
        ("digest", pa.binary()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int64()), ("end", pa.int64())]))),
        ("entities", pa.list_(pa.int64())),
        ("beside", pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.string())]))),
    ]
)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(row_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), digest().alias("digest"), F.col("text").cast("string").alias("text"))


def entities(docs: DataFrame) -> DataFrame:
    """Of every row of documents(doc_id, text): key, doc_id, digest, base spans, its entities (values and their kinds), and terms beside values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                spans, owned, beside = [], [], []
                for text in part.column("text").to_pylist():
                    found = base_spans(text or "")
                    spans.append([{"start": a, "kind": k, "end": b} for a, k, b, _ in found])
                    owned.append(sorted({e for _, k, _, v in found for e in (_entity(k), _entity(k, v))}))
                    beside.append([{"entity": e, "term": t} for e, t in sorted(_beside(_terms(text, found), found))] if found else [])
                made = [pa.array(x, _FOUND.field(n).type) for x, n in zip((spans, owned, beside), _FOUND.names[3:], strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *made], schema=_FOUND)

    schema = "key long, doc_id long, digest binary, spans array<struct<start long, kind long, end long>>, entities array<long>, beside array<struct<entity long, term string>>"
    return _keyed(docs).mapInArrow(run, schema)


_COUNTS = ("n_term", "n_email", "n_ip", "n_card", "n_phone")


def _count(texts: Iterator[str]) -> Iterator[pa.RecordBatch]:
    """(term, n_term, n_email, ...): in how many texts each term stands, and in how many of those that hold each kind of value."""
    counts: dict[str, list[int]] = {}

    def rows() -> pa.RecordBatch:
        columns = np.array(list(counts.values()), np.int64).reshape(-1, len(_COUNTS))
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *[pa.array(c) for c in columns.T]], names=["term", *_COUNTS])

    for text in texts:
        spans = base_spans(text)
        kinds = sorted({k for _, k, _, _ in spans})
        for term in {t for t, *_ in _terms(text, spans)} if spans else {t.lower() for t in set(_TERM.findall(text))}:
            own = counts.get(term)
            if own is None:
                own = counts[term] = [0] * len(_COUNTS)
            own[0] += 1
            for k in kinds:
                own[k + 1] += 1
        if len(counts) > HELD_TERMS:
            yield rows()
            counts.clear()
    if counts:
        yield rows()


def term_counts(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(term, n_term, n_email, n_ip, n_card, n_phone) over distinct texts: copies count once.

    Texts without a copy are counted where they're read, each task sending a term once.  Those that may have one (a filter of fixed
    size tells) leave a task once each, meet by digest, and are counted there.
    """
    repeated = found.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select(F.xxhash64("digest").alias("h"))
    held = docs.sparkSession.sparkContext.broadcast(bit_table(repeated))
    schema = ", ".join(["term string", *(f"{c} long" for c in _COUNTS)])

    def split(batches: Iterator[pa.RecordBatch], copied: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.array([xxhash.xxh64_intdigest(d.as_py(), 42) for d in batch.column("digest")], np.uint64)
            yield from slices(batch.filter(pa.array(in_table(held.value, h) == copied)))

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _count(t or "" for part in split(batches, False) for t in part.column("text").to_pylist())

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for part in split(batches, True):
            keep = []
            for d in part.column("digest").to_pylist():
                keep.append(d not in seen)
                seen.add(d)
            yield part.filter(pa.array(keep, pa.bool_()))

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _count(t or "" for batch in batches for part in slices(batch) for t in part.column("text").to_pylist())

    texts = docs.select(digest().alias("digest"), F.col("text").cast("string").alias("text"))
    once = texts.mapInArrow(several, "digest binary, text string").groupBy("digest").agg(F.first("text").alias("text"))
    counted = texts.mapInArrow(single, schema).union(once.select("text").mapInArrow(met, schema))
    return counted.groupBy("term").agg(*[F.sum(c).alias(c) for c in _COUNTS])


def _share(both: Column, term: Column, entity: Column, total: float) -> Column:
    """Pointwise mutual information of a term and an entity as a share of the entity's own information.

    log(P(e|t) / P(e)) / log(1 / P(e)), where P(e|t) counts PRIOR texts at the entity's own rate beside those seen, so that a few
    texts don't make a term as telling as many do.
    """
    rate = entity / F.lit(total)
    return F.log((both + F.lit(float(PRIOR)) * rate) / (F.greatest(term, both) + F.lit(float(PRIOR))) / rate) / -F.log(rate)


def disclosures(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(entity, term, share, kind): terms that give an entity away, an entity being a value or a whole kind of values.

    All counts are of distinct texts.  A term is seen with an entity in SUPPORT of them at least; one with a share of the entity's
    information from GENERALISE on is generalised, from REMOVE on removed.
    """
    counts = materialise(term_counts(docs, found), "terms")
    total = float(found.select("digest").distinct().count())
    of = found.select("digest", F.explode("entities").alias("entity")).distinct().groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") < total)
    kinds = F.explode(F.array(*[F.struct(F.lit(_entity(k)).alias("entity"), F.col(f"n_{KINDS[k]}").alias("n_both")) for k in range(4)])).alias("k")
    by_kind = counts.select("term", "n_term", kinds).select("k.entity", "term", "n_term", "k.n_both").where(F.col("n_both") >= SUPPORT)
    pairs = found.select("digest", F.explode("beside").alias("b")).select("digest", "b.*").distinct().groupBy("entity", "term").agg(F.count("*").alias("n_both")).where(F.col("n_both") >= SUPPORT)
    by_value = pairs.join(counts.select("term", "n_term"), "term").select("entity", "term", "n_term", "n_both")
    known = by_kind.union(by_value).join(of, "entity").withColumn("share", _share(F.col("n_both"), F.col("n_term"), F.col("n_entity"), total))
    return known.where(F.col("share") >= GENERALISE).select("entity", "term", "share", F.when(F.col("share") >= REMOVE, 5).otherwise(4).cast("long").alias("kind"))


def _places(docs: DataFrame, given: DataFrame) -> DataFrame:
    """(key, digest, entity, term, places): of texts that hold an entity, all places of terms that may disclose it by a filter of pairs."""
    held = docs.sparkSession.sparkContext.broadcast(bit_table(given.select(F.col("entity").bitwiseXOR(F.xxhash64("term")).alias("pair"))))
    types = (pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = []
                for key, name, text in zip(*[part.column(x).to_pylist() for x in ("key", "digest", "text")], strict=True):
                    spans = base_spans(text or "")
                    if not spans:
                        continue
                    places: dict[str, list] = {}
                    for term, a, b in _terms(text, spans):
                        places.setdefault(term, []).append({"start": a, "end": b})
                    terms = list(places)
                    hashes = np.array([xxhash.xxh64_intdigest(t, 42) for t in terms], np.uint64)
                    for entity in {e for _, k, _, v in spans for e in (_entity(k), _entity(k, v))}:
                        likely = in_table(held.value, hashes ^ np.array(entity, np.int64).astype(np.uint64))
                        out += [(key, name, entity, terms[i], places[terms[i]]) for i in np.flatnonzero(likely)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=["key", "digest", "entity", "term", "places"])

    return _keyed(docs).mapInArrow(run, "key long, digest binary, entity long, term string, places array<struct<start long, end long>>")


def private_spans(docs: DataFrame) -> DataFrame:
    """key, digest, doc_id, base (the spans that patterns find) and extra (those of disclosing terms) of every row of docs, as arrays of (start, kind, end)."""
    found = materialise(entities(docs), "entities")
    given = materialise(disclosures(docs, found), "disclosures").select("entity", "term", "kind")
    marked = _places(docs, given).join(given, ["entity", "term"]).select("key", "digest", "kind", F.explode("places").alias("p"))
    spans = marked.groupBy("key", "digest", "p").agg(F.max("kind").alias("kind"))
    extra = spans.groupBy("key", "digest").agg(F.collect_list(F.struct("p.start", "kind", "p.end")).alias("extra"))
    none = F.expr("cast(array() as array<struct<start:bigint,kind:bigint,end:bigint>>)")
    return found.join(extra, ["key", "digest"], "left").select("key", "digest", "doc_id", F.col("spans").alias("base"), F.coalesce("extra", none).alias("extra"))


def find_private(docs: DataFrame) -> DataFrame:
    """Personal data in every whole text of documents(doc_id, text).

    Returns doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of kind:start:end, comma-joined, of the patterns' spans),
    spans (all, with the kinds generalise and remove) and n_terms.  A disclosing term is marked at all its places in each text that
    holds the entity, and in no other.  A null or empty text has no spans.  Every row has the spans of its own text, whatever other
    rows share its id; copies count once in all estimates.  Null ids stay null; other columns are ignored.
    """
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans: F.Column) -> F.Column:
        return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, (s["kind"] + 1).cast("int")), s["start"], s["end"])), ",")

    def number(kind: int) -> F.Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind))  # a second parameter of the lambda, even one with a default, would get the place

    counts = [number(k).cast("long").alias(f"n_{KINDS[k]}") for k in range(4)]
    return private_spans(docs).select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", "extra")).alias("spans"), F.size("extra").cast("long").alias("n_terms"))


def sanitise(docs: DataFrame) -> DataFrame:
    """docs, all rows and columns, with entities and removed terms replaced by [KIND] and generalised terms by their first letter and ***."""
    key, name, found = (free_name(docs, x) for x in ("__key", "__digest", "__spans"))
    spans = private_spans(docs).groupBy(F.col("key").alias(key), F.col("digest").alias(name)).agg(F.first(F.concat("base", "extra")).alias(found))
    names = docs.columns

    def clean(text: str | None, spans: list[dict] | None) -> str | None:
        out, at = [], 0
        for s in sorted(spans or [], key=lambda s: (s["start"], s["kind"], s["end"])):
            if s["start"] < at:
                at = max(at, s["end"])
                continue
            out += [text[at : s["start"]], text[s["start"]] + "***" if s["kind"] == 4 else f"[{KINDS[s['kind']].upper()}]"]
            at = s["end"]
        return text if text is None else "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = pa.array([clean(t, s) for t, s in zip(part.column("text").to_pylist(), part.column(found).to_pylist(), strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([texts if x == "text" else part.column(x) for x in names], names=names)

    joined = docs.withColumns({key: row_key(), name: digest()}).join(spans, [key, name], "left").select(*names, found)
    return joined.mapInArrow(run, docs.schema)
