"""Order-preserving packing: window cuts at document or sentence ends, chosen by dynamic programming with a monotone queue."""

from __future__ import annotations

import re
import struct
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreframe.llm.common import slices

#: Costs in tokens of padding: a window of its own, a cut at a sentence's end, and one inside a sentence.
WINDOW_COST, SENTENCE_COST, INSIDE_COST = 4, 16, 64
#: Cuts inside a sentence are considered every so many tokens, in sentences that are longer.
INSIDE_STEP = 256
#: Tokens over which cuts are chosen at a time.
BLOCK_TOKENS = 1 << 18


class WordTokenizer:
    """Ids of a text, four little-endian bytes each, by a tokenizers file that drops white space.

    White space always ends a token there, so the ids of a text are those of its words, which are kept in a bounded cache.
    A new word of printable Latin-1 goes straight to the model, by the file's own normalization and split; any other
    takes the whole way.
    """

    CACHED, CACHED_CHARS, LONG = 300_000, 8 << 20, 64
    _PLAIN = re.compile(r"[!-~¡-ÿ]+")
    _SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^0-9²³¹¼½¾a-zªµºß-öø-ÿ]+")
    _loaded: dict[str, WordTokenizer] = {}

    def __init__(self, path: str, cached: int = CACHED) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.cached = cached
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = {c: level.pre_tokenize_str(chr(c))[0][0] for c in [*range(33, 127), *range(161, 256)]}
        vocabulary = self.whole.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for t, i in vocabulary.items() if t.removesuffix("</w>")[-1:] in (".", "!", "?")]] = True
        # the words seen lately, and those of the generation before, from which a word is taken over when it's seen again
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.held = 0  # characters of words
        self.parts: dict[str, bytes] = {}
        self.old_parts: dict[str, bytes] = {}
        self.pack = [struct.Struct(f"<{n}I").pack for n in range(32)]

    @classmethod
    def of(cls, path: str, cached: int = CACHED) -> WordTokenizer:
        """One for each Python worker."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path, cached)
        return cls._loaded[path]

    def _part(self, part: str) -> bytes:
        tokens = [t.id for t in self.model.tokenize(part if part.isascii() else part.translate(self.bytes))]
        return self.pack[len(tokens)](*tokens) if len(tokens) < len(self.pack) else np.array(tokens, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if self._PLAIN.fullmatch(word) and "<|" not in word:
            out = []
            for part in self._SPLIT.findall(word.lower()):
                ids = self.parts.get(part)
                if ids is None:
                    ids = self.old_parts.get(part) or self._part(part)
                    if len(part) <= self.LONG:
                        self.parts[part] = ids
                out.append(ids)
            return b"".join(out)
        return np.array(self.whole.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        if len(self.words) > self.cached or self.held > self.CACHED_CHARS:
            self.words, self.old_words, self.held = {}, self.words, 0
        if len(self.parts) > self.cached // 2:
            self.parts, self.old_parts = {}, self.parts
        known = self.words
        for w in {w for w in words if w not in known}:
            known[w] = self.old_words.get(w) or self._word(w)
            self.held += len(w)
        return b"".join([known[w] for w in words])


def choose_cuts(places: list[int], costs: list[int], width: int) -> list[int]:
    """Of the places (ascending, from 0, at most `width` apart) those to cut at, the first and the last included.

    Minimises, over windows of at most `width`, padding to `width` (none at a power of two) and the costs of the cuts.  For all
    ends of windows but powers of two the best begin is the least of cost + place in reach: the head of a monotone queue.
    """
    best, back = [0] * len(places), [0] * len(places)
    queue: deque[tuple[int, int, int]] = deque([(0, 0, 0)])
    at = {0: 0}
    powers = [1 << k for k in range(width.bit_length()) if 1 << k < width]
    seen = at.get
    for j in range(1, len(places)):
        p = places[j]
        while queue[0][1] < p - width:
            queue.popleft()
        value, _, i = queue[0]
        value += width - p
        for power in powers:
            k = seen(p - power)
            if k is not None and best[k] < value:
                value, i = best[k], k
        value += costs[j] + WINDOW_COST
        best[j], back[j] = value, i
        at[p] = j
        key = value + p
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, p, j))
    path = [len(places) - 1]
    while path[-1]:
        path.append(back[path[-1]])
    return [places[j] for j in reversed(path)]


def _candidates(ids: np.ndarray, ends: np.ndarray, closes: np.ndarray, width: int) -> tuple[list[int], list[int]]:
    """Places to cut a stream of ids at, and what each costs; ends: where documents end."""
    total = len(ids)
    cost = np.full(total + 1, -1, np.int32)
    cost[np.flatnonzero(closes[np.minimum(ids, len(closes) - 1)]) + 1] = SENTENCE_COST
    cost[ends] = 0
    cost[[0, total]] = 0
    found = np.flatnonzero(cost >= 0)
    step = min(INSIDE_STEP, width)
    for g in np.flatnonzero(np.diff(found) > step):
        cost[found[g] + step : found[g + 1] : step] = INSIDE_COST
    found = np.flatnonzero(cost >= 0)
    return found.tolist(), cost[found].tolist()


class _Packer:
    """Takes documents in order and gives pieces; holds a block of tokens and the window that isn't closed yet."""

    def __init__(self, closes: np.ndarray, width: int, first: int) -> None:
        self.closes, self.width, self.sequence = closes, width, first
        self.docs: list[tuple[int | None, bytes]] = []
        self.skip = 0  # tokens of the first document that are packed
        self.held = 0

    def add(self, doc: int | None, ids: bytes) -> list[tuple]:
        self.docs.append((doc, ids))
        self.held += len(ids) // 4
        return self.pack(False) if self.held - self.skip >= BLOCK_TOKENS else []

    def pack(self, last: bool) -> list[tuple]:
        if not self.docs:
            return []
        sizes = np.array([len(x) // 4 for _, x in self.docs])
        ends = np.cumsum(sizes) - self.skip
        ids = np.frombuffer(b"".join([x for _, x in self.docs]), "<u4")[self.skip :]
        cuts = choose_cuts(*_candidates(ids, ends, self.closes, self.width), self.width)
        if not last:
            cuts.pop()
        out, d, done = [], 0, self.skip
        for a, b in zip(cuts, cuts[1:], strict=False):
            at = a
            while at < b:
                doc, raw = self.docs[d]
                n = min(b - at, int(sizes[d]) - done)
                out.append((doc, done, n, zlib.crc32(raw[4 * done : 4 * (done + n)]), int(sizes[d]), self.sequence, at - a))
                at, done = at + n, done + n
                if done == sizes[d]:
                    d, done = d + 1, 0
            self.sequence += 1
        self.docs, self.skip = self.docs[d:], done
        self.held = sum(len(x) // 4 for _, x in self.docs)
        return out


_PIECES = pa.schema([(x, pa.int64()) for x in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def pack_documents(docs: DataFrame, tokenizer: str, width: int = 4096, end_id: int = 2, cached: int = WordTokenizer.CACHED, keep: bool = True) -> DataFrame:
    """Pack documents(doc_id, text) into sequences of at most `width` ids, in the order in which they come.

    tokenizer: path of a tokenizers file, on every machine; `end_id` follows each document; cached: words whose ids a Python worker
    keeps, twice (some 250 bytes each), which changes nothing but time; keep: whether it keeps them and the tokenizer for its next task.  Returns a row per piece:
    doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset.  A partition is packed by itself, without a shuffle:
    its number leads the sequence_ids.  Cuts are the best ones for each BLOCK_TOKENS of tokens with what the block before left
    over, and the last sequence of a partition is the only one with more padding than a choice of cuts saves.
    Null and empty texts are the end id alone; null ids and repeated rows are packed as they come; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokenizer.of(tokenizer, cached) if keep else WordTokenizer(tokenizer, cached)
        end = end_id.to_bytes(4, "little")
        packer = _Packer(words.closes, width, TaskContext.get().partitionId() << 40)

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*pieces, strict=True)], schema=_PIECES)

        for batch in batches:
            for part in slices(batch):
                out = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    out += packer.add(doc, words.encode(text or "") + end)
                if out:
                    yield rows(out)
        if out := packer.pack(True):
            yield rows(out)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ", ".join(f"{x} long" for x in _PIECES.names))
