"""Line deduplication by a log-template tree: token count and leading tokens choose a leaf, which divides further where its lines are of several templates."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreframe.llm.common import bit_table, digest, free_name, in_table, materialise, slices

#: Leading tokens that choose a leaf below its token count.
DEPTH = 3
#: Documents in which a template recurs, and the part of the rest of such a document that must be its own.
RECURS, OWN = 3, 0.5
#: A token is constant if it stands at its place in this part of its leaf's lines; constant tokens a template has at least.
DOMINANT, CONSTANT = 0.3, 0.6
#: Times that a leaf is divided by the tokens of a further place.
SPLITS = 2
#: A line without tokens beyond the leading ones must stand so many times as often as chance would put its words beside each other, by so many
#: nats of a Poisson tail; either way of a place in the corpus, so neither depends on the corpus' size or on how many such lines there are.
LIFT, NATS = 10, 20
#: Buckets in which the words of running text are counted, parts in which the counts are added up, and ends of words that don't tell them apart.
WORD_BUCKETS, WORD_PARTS, ENDS = 1 << 18, 16, ".,"
#: Words of the runs of which a line's least stands for it, where copies are to be told from other texts.
RUN = 5
#: Leaves and runs that a task holds.
HELD = 60_000
#: Text that a task holds as tokens at a time.
PARSED_BYTES = 1 << 19

_FIELD = re.compile(rb"[0-9@]|://")
_MARK = b"<*>"
_LOW = (1 << 48) - 1
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _masked(token: bytes) -> bytes:
    """Tokens with a digit, an at sign or a scheme are variable fields from the start."""
    return _MARK if _FIELD.search(token) else token


def _masked_line(line: bytes, tokens: list[bytes]) -> bytes:
    """The masked tokens of a line; one without a field, as most of prose, is searched once."""
    return b" ".join(map(_masked, tokens) if _FIELD.search(line) else tokens)


def _leaf(tokens: list[bytes]) -> int:
    """Where the tree sends a line: by its number of tokens, then by its leading ones."""
    leading = b" ".join(tokens[:DEPTH])
    if _FIELD.search(leading):
        leading = b" ".join([_masked(t) for t in tokens[:DEPTH]])
    return xxhash.xxh64_intdigest(b"%d %b" % (len(tokens), leading), 42) - (1 << 63)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(digest().alias("digest"), F.col("text").cast("string").alias("text"))


def _sketches(lines: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """For each line of some tokens the least hash of its runs of RUN tokens, or that of all its tokens: edits of a few seldom change it.  And the
    hashes of the tokens of running text: of lines beyond the leading ones."""
    many = np.fromiter(map(len, lines), np.int64, len(lines))
    starts = np.cumsum(many) - many
    words = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(lines)), np.uint64, int(many.sum()))
    padded = np.concatenate((words, np.zeros(RUN, np.uint64)))
    runs, whole = np.zeros(len(words), np.uint64), np.zeros(len(lines), np.uint64)
    for k in range(RUN):
        runs = runs * _ODD + padded[k : k + len(words)]
        whole = np.where(many > k, whole * _ODD + padded[starts + k], whole)
    runs = (runs ^ (runs >> np.uint64(32))) * _ODD
    for k in range(1, RUN):  # the last ones of a line go beyond it
        runs[(starts + many - k)[many >= k]] = np.iinfo(np.uint64).max
    least = np.minimum.reduceat(runs, starts) if len(lines) else runs
    return np.where(many < RUN, (whole ^ (whole >> np.uint64(32))) * _ODD, least).view(np.int64), words[np.repeat(many > DEPTH, many)]


def _parsed(texts: list[str | None]) -> tuple[list[tuple[int, int, bytes, list[bytes]]], np.ndarray, np.ndarray]:
    """(text, number, line, tokens) of the lines of texts that aren't blank, their sketches, and the hashes of the tokens of running text."""
    split = [(i, at, line, line.split()) for i, text in enumerate(texts) if text for at, line in enumerate(text.encode().split(b"\n"))]
    split = [x for x in split if x[3]]
    return split, *_sketches([x[3] for x in split])


class Chance(NamedTuple):
    """How often words stand in running text, by buckets of their hashes, how many words that is, and how many lines there are of each length up to DEPTH."""

    words: np.ndarray
    total: int
    lines: np.ndarray

    def expected(self, tokens: list[str]) -> float:
        """In how many lines chance would put these tokens: case and ENDS aside, each as often as in running text; fields count as sure."""
        out = float(self.lines[len(tokens)])
        for token in tokens:
            if token != "<*>":
                word = token.strip(ENDS).lower() or token
                forms = {f"{form}{end}" for form in (word, word.capitalize()) for end in ("", *ENDS)} | {token}
                at = {xxhash.xxh64_intdigest(f) % WORD_BUCKETS for f in forms}
                out *= (int(self.words[sorted(at)].sum()) + 1) / (self.total + 1)
        return out

    def unlikely(self, tokens: list[str], n: int) -> bool:
        """Whether n lines are too many for chance."""
        e = self.expected(tokens)
        return n >= LIFT * e and n * (np.log(n / e) - 1) + e >= NATS


def _recurring(docs: DataFrame) -> DataFrame:
    """(h): leaves and sketches of RECURS distinct texts at least.  A task names RECURS texts of each at most, since more make no difference."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[bytes, ...]] = {}

        def rows() -> pa.RecordBatch:
            pairs = [(h, d) for h, own in found.items() for d in own]
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.int64()), pa.array([d for _, d in pairs], pa.binary())], names=["h", "digest"])

        for batch in batches:
            for part in slices(batch, size=PARSED_BYTES):
                names = part.column(0).to_pylist()
                lines, sketches, _ = _parsed(part.column(1).to_pylist())
                for (i, _, _, tokens), sketch in zip(lines, sketches.tolist(), strict=True):
                    for h in (_leaf(tokens), sketch):
                        own = found.get(h)
                        if own is None:
                            found[h] = (names[i],)
                        elif len(own) < RECURS and names[i] not in own:
                            found[h] = (*own, names[i])
                if len(found) > HELD:
                    yield rows()
                    found.clear()
        if found:
            yield rows()

    pairs = _texts(docs).mapInArrow(run, "h long, digest binary").distinct()
    return pairs.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= RECURS).select("h")


def _lines(docs: DataFrame, recurring: DataFrame) -> tuple[DataFrame, Chance]:
    """Of distinct texts, those of copies in different tasks coming again: digest, all (bytes of its lines), and of each distinct masked line of
    which the leaf or the sketch may recur: leaf, sketch, id, line, bytes, and the numbers of the lines that read so (at).  And how often words stand in
    running text, which each task counts in the same pass (part, counts)."""
    held = docs.sparkSession.sparkContext.broadcast(bit_table(recurring))
    names = ["digest", "all", "leaf", "sketch", "id", "line", "bytes", "at", "part", "counts"]
    types = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        words, lengths = np.zeros(WORD_BUCKETS, np.int64), np.zeros(DEPTH + 1, np.int64)
        for batch in batches:
            for part in slices(batch, size=PARSED_BYTES):
                keep, digests = [], part.column(0).to_pylist()
                for name in digests:
                    keep.append(name not in seen)
                    seen.add(name)
                lines, sketches, running = _parsed(part.column(1).to_pylist())
                words += np.bincount((running % np.uint64(WORD_BUCKETS)).astype(np.int64), minlength=WORD_BUCKETS)
                lengths += np.bincount([len(t) for *_, t in lines if len(t) <= DEPTH], minlength=DEPTH + 1)
                leaves = np.array([_leaf(t) for *_, t in lines], np.int64)
                size = np.zeros(len(digests), np.int64)
                np.add.at(size, [i for i, *_ in lines], [len(x) for *_, x, _ in lines])
                found: dict[tuple[int, int, bytes], list] = {}
                for k in np.flatnonzero(in_table(held.value, leaves) | in_table(held.value, sketches)):
                    i, at, line, tokens = lines[k]
                    if not keep[i]:
                        continue
                    own = found.setdefault((i, int(leaves[k]), _masked_line(line, tokens)), [int(sketches[k]), 0, []])
                    own[1] += len(line)
                    own[2].append(at)
                out = [(digests[i], int(size[i]), leaf, sketch, xxhash.xxh64_intdigest(line, 42) - (1 << 63), line.decode(), n, at) for (i, leaf, line), (sketch, n, at) in found.items()]
                if out:
                    columns = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=False)]
                    yield pa.RecordBatch.from_arrays([*columns, *(pa.nulls(len(out), t) for t in types[8:])], names=names)
        counts = [*(x.tobytes() for x in np.split(words, WORD_PARTS)), lengths.tobytes()]
        yield pa.RecordBatch.from_arrays([*(pa.nulls(len(counts), t) for t in types[:8]), pa.array(range(len(counts)), pa.int32()), pa.array(counts, pa.binary())], names=names)

    schema = "digest binary, all long, leaf long, sketch long, id long, line string, bytes long, at array<int>, part int, counts binary"
    found = materialise(_texts(docs).mapInArrow(run, schema), "lines")
    return found.where("part is null").drop("part", "counts"), _chance(found.where("part is not null").select("part", "counts"))


def _chance(counts: DataFrame) -> Chance:
    """The counts of all tasks (part, counts) added up, each part in a task of its own."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sums[part] = sums.get(part, 0) + np.frombuffer(counts.as_py(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["part", "counts"])

    parts = {r.part: np.frombuffer(r.counts, np.int64) for r in counts.repartition("part").mapInArrow(added, "part int, counts binary").collect()}
    words = np.concatenate([parts[i] for i in range(WORD_PARTS)]) if parts else np.zeros(WORD_BUCKETS, np.int64)
    return Chance(words, int(words.sum()), parts.get(WORD_PARTS, np.zeros(DEPTH + 1, np.int64)))


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, token, n) of lines (node, line, n), added up within a batch; a token is 48 bits of its hash below its place."""
    for batch in batches:
        for part in slices(batch, "line"):
            counts: Counter = Counter()
            for node, line, n in zip(*[part.column(x).to_pylist() for x in ("node", "line", "n")], strict=True):
                for place, token in enumerate(line.split(" ")):
                    if place >= DEPTH and token != "<*>":
                        counts[node, place << 48 | xxhash.xxh64_intdigest(token, 42) & _LOW] += n
            yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in counts], pa.int64()) for i in range(2)] + [pa.array(list(counts.values()), pa.int64())], names=["node", "token", "n"])


def _token(token: Column, place: Column) -> Column:
    """A token at a place as _token_counts names it."""
    return F.shiftleft(place.cast("long"), 48).bitwiseOR(F.xxhash64(token).bitwiseAND(F.lit(_LOW)))


def _node_counts(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, total) of nodes with RECURS texts and several lines at least, and (node, token, n) of their tokens in RECURS texts."""
    totals = lines.groupBy("node").agg(F.sum("n").alias("total"), F.count("*").alias("many")).where((F.col("total") >= RECURS) & (F.col("many") > 1)).select("node", "total")
    counts = lines.select("node", "line", "n").join(totals.select("node"), "node", "left_semi").mapInArrow(_token_counts, "node long, token long, n long")
    return totals, materialise(counts.groupBy("node", "token").agg(F.sum("n").alias("n")).where(F.col("n") >= RECURS), "tokens")


def templates(lines: DataFrame, totals: DataFrame, counts: DataFrame) -> DataFrame:
    """(leaf, id, template, n) of lines (leaf, node, id, line, n), n texts having each: the template its node makes of a line.

    A token stays where DOMINANT of the node's lines have it at its place; any other is a variable field.  That is decided from
    counts alone, so templates don't depend on the order of lines or on how they're spread, and as shares, so they don't loosen as
    a corpus grows.  Lines with too many fields for their tokens beyond the leading ones have no template.
    """
    constant = counts.join(totals, "node").where(F.col("n") >= DOMINANT * F.col("total")).groupBy("node").agg(F.collect_list("token").alias("constants"))
    words = F.split("line", " ")
    masked = F.transform(words, lambda t, i: F.when((i < DEPTH) | (t == "<*>") | F.array_contains("constants", _token(t, i)), t).otherwise(F.lit("<>")))
    made = lines.join(constant, "node").select("leaf", "node", "id", "n", masked.alias("made"))
    fields, marks, size = (F.size(F.filter("made", lambda t: t == "<>")), F.size(F.filter("made", lambda t: t == "<*>")), F.size("made"))
    return made.where((fields <= (1 - CONSTANT) * F.greatest(size - DEPTH, F.lit(0))) & (size - fields - marks >= CONSTANT * size)).select("leaf", "id", F.xxhash64("node", "made").alias("template"), "n")


def divided(lines: DataFrame, totals: DataFrame, counts: DataFrame) -> DataFrame:
    """The lines under nodes one token deeper: each node divides by the tokens of that place where most of its lines have a token which recurs.

    Places that don't divide a node, since all its lines have one token there, don't count; of equal ones that with the fewest tokens does.  All
    lines without a recurring token there go to one node.
    """
    place = F.shiftright("token", 48)
    at = counts.groupBy("node", place.alias("place")).agg(F.sum("n").alias("covered"), F.count("*").alias("many"), F.max("n").alias("most")).join(totals, "node").where("most < total")
    best = at.groupBy("node").agg(F.max(F.struct("covered", (-F.col("many")).alias("few"), (-F.col("place")).alias("left"))).alias("b")).select("node", (-F.col("b.left")).alias("place"))
    children = counts.withColumn("place", place).join(best, ["node", "place"]).select("node", "token", F.lit(True).alias("child"))
    placed = lines.join(best, "node").withColumn("token", _token(F.get(F.split("line", " "), F.col("place").cast("int")), F.col("place")))
    return placed.join(children, ["node", "token"], "left").select("leaf", F.xxhash64("node", "place", F.when(F.col("child"), F.col("token"))).alias("node"), "id", "line", "n")


def grouped(lines: DataFrame) -> DataFrame:
    """(leaf, id, group, size, short): the masked lines that RECURS distinct texts have, as they are or as a template; of one template, one group.

    Lines that a leaf makes no recurring template of are looked at again in the nodes that it divides into, SPLITS times.  short: the line, where it has
    none but leading tokens.
    """
    counted = materialise(lines.groupBy("leaf", "id", "digest").agg(F.first("line").alias("line")).groupBy("leaf", "id").agg(F.first("line").alias("line"), F.count("*").alias("n")), "counted")
    words = F.split("line", " ")
    size, marks = F.size(words), F.size(F.filter(words, lambda t: t == "<*>"))
    left, alike = counted.where(size > DEPTH).select("leaf", F.col("leaf").alias("node"), "id", "line", "n"), None
    for level in range(SPLITS + 1):
        totals, counts = _node_counts(left)
        made = materialise(templates(left, totals, counts), "templates")
        several = made.groupBy("leaf", "template").agg(F.sum("n").alias("n"), F.count("*").alias("many")).where((F.col("n") >= RECURS) & (F.col("many") > 1)).select("leaf", "template")
        found = made.join(several, ["leaf", "template"]).select("leaf", "id", F.col("template").alias("group"))
        alike = found if alike is None else alike.union(found)
        if level < SPLITS:
            left = materialise(divided(left.join(found, ["leaf", "id"], "left_anti"), totals, counts), "nodes")
    alone = counted.where((F.col("n") >= RECURS) & (size - marks >= CONSTANT * size)).join(alike, ["leaf", "id"], "left_anti").select("leaf", "id", F.col("id").alias("group"))
    return alike.union(alone).join(counted.select("leaf", "id", size.alias("size"), F.when(size <= DEPTH, F.col("line")).alias("short")), ["leaf", "id"])


def evidence(lines: DataFrame, groups: DataFrame, recurring: DataFrame) -> DataFrame:
    """(leaf, group, n): in how many distinct texts that are otherwise their own a line of each group stands.

    Of such a text, OWN of the bytes beside the line at least lie in lines whose sketch doesn't recur.  Near copies share most
    of their lines but for a few edits, so however many there are of a text, they don't make its lines boilerplate; nor do copies,
    which are one text.
    """
    one = lines.select("digest", "all", "leaf", "sketch", "id", "bytes").distinct()
    one = materialise(one.join(recurring.select(F.col("h").alias("sketch"), F.lit(True).alias("shared")), "sketch", "left"), "flagged").na.fill(False, ["shared"])
    common = F.when(F.col("shared"), F.col("bytes")).otherwise(0)
    of = one.groupBy("digest").agg(F.sum(common).alias("common"))
    rest = F.col("all") - F.col("bytes")
    own = rest - (F.col("common") - common)
    held = one.join(groups.select("leaf", "id", "group"), ["leaf", "id"]).join(of, "digest")
    return held.where((own > 0) & (own >= OWN * rest)).groupBy("leaf", "group").agg(F.count("*").alias("n"))


def _by_no_chance(groups: DataFrame, chance: Chance) -> DataFrame:
    """(leaf, group) of groups (leaf, group, short, n), without the short lines that chance may have put together."""
    held = groups.sparkSession.sparkContext.broadcast(chance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [short is None or held.value.unlikely(short.split(" "), n) for short, n in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield batch.select(["leaf", "group"]).filter(pa.array(keep, pa.bool_()))

    return groups.select("leaf", "group", "short", "n").mapInArrow(run, "leaf long, group long")


def recurring_lines(lines: DataFrame, recurring: DataFrame, chance: Chance) -> DataFrame:
    """(leaf, id): the masked lines of groups that recur in texts which are otherwise their own."""
    groups = materialise(grouped(lines.join(recurring.withColumnRenamed("h", "leaf"), "leaf", "left_semi")), "line-groups")
    short = groups.groupBy("leaf", "group").agg(F.first("short").alias("short"))
    kept = _by_no_chance(short.join(evidence(lines, groups, recurring), ["leaf", "group"]).where(F.col("n") >= RECURS), chance)
    return groups.join(kept, ["leaf", "group"], "left_semi").select("leaf", "id")


def boilerplate(docs: DataFrame) -> DataFrame:
    """(digest, lines): of each distinct text the numbers of the lines whose template recurs across documents."""
    recurring = materialise(_recurring(docs), "recurring")
    lines, chance = _lines(docs, recurring)
    dropped = lines.join(recurring_lines(lines, recurring, chance), ["leaf", "id"], "left_semi").groupBy("digest", "leaf", "id").agg(F.first("at").alias("at"))
    return dropped.groupBy("digest").agg(F.flatten(F.collect_list("at")).alias("lines"))


def _marked(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with the numbers of the lines to drop, and the name of that column."""
    name, lines = free_name(docs, "__digest"), free_name(docs, "__lines")
    found = boilerplate(docs).select(F.col("digest").alias(name), F.col("lines").alias(lines))
    # merged by text at every size, so that the plan and what it moves don't change with the input
    return docs.withColumn(name, digest()).join(found.hint("merge"), name, "left").select(*docs.columns, lines), lines


def _without(text: str | None, lines: list[int] | None) -> str | None:
    if not text or not lines:
        return text
    drop = set(lines)
    return "\n".join([x for i, x in enumerate(text.split("\n")) if i not in drop])


def _left(part: pa.RecordBatch, lines: str) -> list[str | None]:
    return [_without(t, x) for t, x in zip(part.column("text").to_pylist(), part.column(lines).to_pylist(), strict=True)]


def drop_boilerplate(docs: DataFrame) -> DataFrame:
    """docs, all rows and columns, without the lines whose template recurs across documents; n_chars, where there is one, follows.

    A template recurs if it stands in RECURS distinct texts that are otherwise their own (see evidence); one-word lines and others
    that are all leading tokens must also stand far more often than chance would have it (see Chance).  Blank lines stay, as do null and
    empty texts; a text of nothing else becomes empty.  Every row loses the lines of its own text, whatever other rows share its id.
    """
    names = docs.columns
    marked, lines = _marked(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = _left(part, lines)
                columns = [pa.array(texts, pa.string()) if x == "text" else pa.array([None if t is None else len(t) for t in texts], part.column(x).type) if x == "n_chars" else part.column(x) for x in names]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return marked.mapInArrow(run, docs.schema)


def line_report(docs: DataFrame) -> DataFrame:
    """For each row of documents(doc_id, text): doc_id, n_lines, n_dropped, kept_bytes and kept_sha256 of the text that drop_boilerplate leaves (null: empty)."""
    names = ("doc_id", "n_lines", "n_dropped", "kept_bytes", "kept_sha256")
    marked, lines = _marked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                many = [(t or "").count("\n") + 1 for t in part.column("text").to_pylist()]
                kept = [(t or "").encode() for t in _left(part, lines)]
                gone = [len(x or ()) for x in part.column(lines).to_pylist()]
                columns = [part.column("doc_id"), *[pa.array(x, pa.int64()) for x in (many, gone, [len(k) for k in kept])], pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return marked.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_bytes long, kept_sha256 string")
