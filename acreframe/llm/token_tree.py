"""Token counts that follow edits: a segment tree over runs of pre-tokens for each document."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreframe.llm.common import slices

#: Characters of a segment, from which on it ends at the next sure boundary of pre-tokens.
SEGMENT = 256

#: Fixed value: the pattern by which byte-level BPE vocabularies of this kind split text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: No pre-token reaches over these places, whatever stands further off: before a single space between other characters, and between a letter and a digit.
_SURE = regex.compile(r"(?<=\S)(?= \S)|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")

_counters: dict[str, Callable[[str], int]] = {}


def counter(path: str) -> Callable[[str], int]:
    """Number of tokens of a text by a rank file; loaded once for each Python worker."""
    if path not in _counters:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encode = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        _counters[path] = lambda text: len(encode(text))
    return _counters[path]


def segments(text: str, size: int = SEGMENT) -> list[str]:
    """Cut at the first sure boundary from `size` characters on; a run of letters without one, as of some scripts, is one segment however long."""
    out, start = [], 0
    while found := _SURE.search(text, start + size):
        out.append(text[start : found.start()])
        start = found.start()
    return [*out, text[start:]]


class TokenTree:
    """Leaves are segments with their token counts, inner nodes hold sums; an edit cuts the leaves it touches anew and updates their paths."""

    def __init__(self, text: str, count: Callable[[str], int], size: int = SEGMENT) -> None:
        self.count, self.size = count, size
        self.encoded = 0  # characters encoded for edits
        self.parts = segments(text, size)
        self._grow([count(part) for part in self.parts])

    def _grow(self, tokens: list[int]) -> None:
        """The sums over the leaves of self.parts, whose token counts are known."""
        self.width = 1 << (len(self.parts) - 1).bit_length()
        spare = [0] * (self.width - len(tokens))
        self.tokens = [0] * self.width + tokens + spare
        self.chars = [0] * self.width + [len(part) for part in self.parts] + spare
        for i in range(self.width - 1, 0, -1):
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(self.parts)

    def _leaf(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and the place of its first one; behind the last, the last leaf that isn't empty."""
        place, node, before = max(0, min(place, self.length - 1)), 1, 0
        while node < self.width:
            node *= 2
            if place - before >= self.chars[node]:
                before += self.chars[node]
                node += 1
        return node - self.width, before

    def _put(self, leaf: int, part: str) -> None:
        self.parts[leaf] = part
        node = leaf + self.width
        tokens = self.count(part) if part else 0
        more, longer = tokens - self.tokens[node], len(part) - self.chars[node]
        while node:
            self.tokens[node] += more
            self.chars[node] += longer
            node //= 2

    def edit(self, start: int, end: int, new: str) -> None:
        """Put `new` in place of the characters from start to end (both within the text).

        The touched leaves and the nearest filled one on either side are cut and encoded again; the boundaries beyond those stand
        between characters that the edit doesn't reach.  What doesn't fit into their places makes the tree grow, without encoding more.
        """
        start = max(0, min(start, self.length))
        end = max(start, min(end, self.length))
        first, before = self._leaf(start)
        last, _ = self._leaf(max(start, end - 1))
        left, right = first - 1, last + 1
        while left >= 0 and not self.parts[left]:
            left -= 1
        while right < len(self.parts) and not self.parts[right]:
            right += 1
        low, high = (left if left >= 0 else first), (right if right < len(self.parts) else last)
        before -= len(self.parts[left]) if left >= 0 else 0
        old = "".join(self.parts[low : high + 1])
        changed = old[: start - before] + new + old[end - before :]
        self.encoded += len(changed)
        parts = segments(changed, self.size)
        if len(parts) <= high + 1 - low:
            for leaf, part in zip(range(low, high + 1), parts + [""] * (high + 1 - low - len(parts)), strict=True):
                if part != self.parts[leaf]:
                    self._put(leaf, part)
        else:
            tokens = self.tokens[self.width : self.width + len(self.parts)]
            self.parts[low : high + 1] = parts
            self._grow(tokens[:low] + [self.count(part) for part in parts] + tokens[high + 1 :])


def count_tokens(docs: DataFrame, edits: Column, ranks: str) -> DataFrame:
    """Token counts of documents(doc_id, text) before and after the edits of each.

    edits: an array of (start, stop, new), applied in order, each to the text the ones before have left; null is no edit.
    Places are characters and are clipped to the text.  Returns doc_id, n_tokens, n_tokens_after, n_chars_after,
    n_segments and n_encoded, the characters encoded for the edits.  Null texts count as empty; null ids and repeated rows stay.
    """
    names = ("doc_id", "n_tokens", "n_tokens_after", "n_chars_after", "n_segments", "n_encoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(ranks)
        for batch in batches:
            for part in slices(batch):
                rows = []
                for doc, text, changes in zip(*[part.column(x).to_pylist() for x in ("doc_id", "text", "edits")], strict=True):
                    tree = TokenTree(text or "", count)
                    before = tree.total
                    for e in changes or []:
                        if e is not None:
                            tree.edit(e["start"] or 0, e["stop"] or 0, e["new"] or "")
                    rows.append((doc, before, tree.total, tree.length, len(tree.parts), tree.encoded))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), edits.alias("edits"))
    return rows.mapInArrow(run, ", ".join(f"{x} long" for x in names))


def derived_edits(n: int = 3) -> Column:
    """n edits of each text from its own contents: at hashed places up to 40 characters give way to up to 40 from elsewhere in it."""

    def place(i: int, what: int, below: Column) -> Column:
        return F.pmod(F.xxhash64("doc_id", "text", F.lit(i), F.lit(what)), F.greatest(below, F.lit(1)).cast("long"))

    size = F.length("text")
    changes = []
    for i in range(n):
        start, many = place(i, 0, size), place(i, 2, F.lit(41))
        changes.append(F.struct(start.alias("start"), (start + place(i, 1, F.lit(41))).alias("stop"), F.substring(F.col("text"), (place(i, 3, size) + 1).cast("int"), many.cast("int")).alias("new")))
    return F.array(*changes)
