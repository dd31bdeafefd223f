"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreframe.llm.common import slices

#: Kinds of bytes: lower case, upper case, digit, space, mark of prose, exclamation, bar, other symbol, beyond ASCII.
_KINDS = np.array([3 if chr(c) in " \t\r\n" else 0 if 97 <= c <= 122 else 1 if 65 <= c <= 90 else 2 if 48 <= c <= 57 else 8 if c >= 128 else 5 if c == 33 else 6 if c == 124 else 4 if chr(c) in ".,;:'\"?-()" else 7 for c in range(256)], np.uint8)
OWN = 14
FEATURES = 3 * OWN
#: Log odds against the label of its document from which on a line is given the other one, and the part of a document that others may make.
MARGIN, MINORITY = 1.0, 0.5


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, their lengths in bytes, and the number of lines of each text.

    A null or empty text is one empty line.  Each line has its own features, then those of the line before and the one behind
    (zeros at the ends): shares of kinds of bytes, length, words and their variety, its end, and whether the text holds it twice.
    """
    lines: list[bytes] = []
    counts, variety, twice = [], [], []
    for text in texts:
        own = (text or "").encode().split(b"\n")
        counts.append(len(own))
        lines += own
        known: set[bytes] = set()
        for line in own:
            words = line.split()
            variety.append((len(words), len(set(words))))
            twice.append(len(line) > 20 and line in known)
            known.add(line)
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    kinds = _KINDS[np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)]
    starts = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
    share = np.stack([np.add.reduceat(kinds == k, starts, dtype=np.int32) for k in range(9)], axis=1).astype(np.float64)
    share[:, 3] -= 1  # the line feed
    words = np.array(variety, np.float64).reshape(-1, 2)
    own = np.empty((len(lines), OWN))
    letters = share[:, 0] + share[:, 1]
    own[:, :9] = share / np.maximum(size, 1)[:, None]
    own[:, 1] = share[:, 1] / np.maximum(letters, 1)
    own[:, 9] = np.log1p(size)
    own[:, 10] = np.log1p(size / np.maximum(words[:, 0], 1))
    own[:, 11] = words[:, 1] / np.maximum(words[:, 0], 1)
    own[:, 12] = [x[-1:] in (b".", b"!", b"?", b":") for x in lines]
    own[:, 13] = twice
    many = np.array(counts)
    first = np.concatenate(([0], np.cumsum(many)[:-1])).astype(np.int64)
    before, behind = np.zeros_like(own), np.zeros_like(own)
    before[1:], behind[:-1] = own[:-1], own[1:]
    before[first], behind[first + many - 1] = 0, 0
    return np.concatenate((own, before, behind), axis=1), size, many


def _sweep(score: np.ndarray, many: np.ndarray, move: np.ndarray, forward: bool) -> np.ndarray:
    """Log odds of the messages that reach each line from one side; move[a, b]: weight of a step from label a to b."""
    message = np.zeros(len(score))
    first = np.concatenate(([0], np.cumsum(many)[:-1])).astype(np.int64)
    order = np.argsort(-many, kind="stable")
    first, left = first[order], many[order]
    step = move if forward else move.T
    held = np.zeros(len(many))
    for t in range(1, int(left.max(initial=0))):
        live = int(np.searchsorted(-left, -t, side="left"))
        at = first[:live] + (t - 1 if forward else left[:live] - t)
        odds = held[:live] + score[at]
        held[:live] = np.logaddexp(odds + step[1, 1], step[0, 1]) - np.logaddexp(odds + step[1, 0], step[0, 0])
        message[at + (1 if forward else -1)] = held[:live]
    return message


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


@dataclass
class LineModel:
    """weight, bias: of the standardised features for the label good; move: of steps between labels; slope, level: calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float
    move: np.ndarray
    slope: float = 1.0
    level: float = 0.0

    def marginals(self, features: np.ndarray, many: np.ndarray) -> np.ndarray:
        """Probability of good for each line, by forward and backward sweeps."""
        score = ((features - self.mean) / self.scale) @ self.weight + self.bias
        return _sigmoid(_sweep(score, many, self.move, True) + score + _sweep(score, many, self.move, False))

    def odds(self, texts: list[str | None]) -> np.ndarray:
        features, size, many = line_features(texts)
        good = self.marginals(features, many)
        first = np.concatenate(([0], np.cumsum(many)[:-1])).astype(np.int64)
        part = np.add.reduceat(good * (size + 1), first) / np.add.reduceat(size + 1, first)
        part = np.clip(part, 1e-6, 1 - 1e-6)
        return np.log(part / (1 - part))

    def score(self, texts: list[str | None]) -> np.ndarray:
        return _sigmoid(self.slope * self.odds(texts) + self.level) if texts else np.zeros(0)


def likelihood(theta: np.ndarray, x: np.ndarray, y: np.ndarray, many: np.ndarray, ridge: float = 1.0) -> tuple[float, np.ndarray]:
    """Log likelihood of the line labels y under theta (weights, bias and the four steps), less the ridge, and its gradient."""
    inner = np.ones(len(x), bool)
    inner[np.cumsum(many) - 1] = False
    now, last = np.flatnonzero(inner), np.flatnonzero(~inner)  # lines that have a next one, and those that don't
    seen = np.array([[np.sum((1 - y[now]) * (1 - y[now + 1])), np.sum((1 - y[now]) * y[now + 1])], [np.sum(y[now] * (1 - y[now + 1])), np.sum(y[now] * y[now + 1])]])
    move = theta[-4:].reshape(2, 2)
    score = x @ theta[:-5] + theta[-5]
    ahead, behind = _sweep(score, many, move, True), _sweep(score, many, move, False)
    p = _sigmoid(ahead + score + behind)
    a, b = (ahead + score)[now], (score + behind)[now + 1]
    joint = np.stack([np.full(len(now), move[0, 0]), b + move[0, 1], a + move[1, 0], a + b + move[1, 1]])
    joint = np.exp(joint - joint.max(axis=0, initial=-np.inf))
    joint = (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)
    total = np.sum(np.logaddexp(a + move[1, 0], move[0, 0])) + np.sum(np.logaddexp(0, (ahead + score)[last]))
    value = np.sum(score * y) + np.sum(seen * move) - total - ridge / 2 * theta @ theta
    return float(value), np.concatenate((x.T @ (y - p), [np.sum(y - p)], (seen - joint).ravel())) - ridge * theta


def _ascend(x: np.ndarray, y: np.ndarray, many: np.ndarray, rounds: int, ridge: float) -> np.ndarray:
    theta = np.zeros(x.shape[1] + 5)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for r in range(1, rounds + 1):
        slope = likelihood(theta, x, y, many, ridge)[1] / len(x)
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        theta += 0.1 * (first / (1 - 0.9**r)) / (np.sqrt(second / (1 - 0.99**r)) + 1e-8)
    return theta


def line_labels(odds: np.ndarray, labels: np.ndarray, size: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Labels of lines that agree with those of their documents: a line whose log odds speak against its document's label by MARGIN
    gets the other label, the clearest first, as long as such lines make less than MINORITY of the document's bytes."""
    own = np.repeat(labels, many)
    against = np.where(own > 0, -odds, odds)
    doc = np.repeat(np.arange(len(many)), many)
    order = np.lexsort((-against, doc))
    length = (size + 1)[order]
    first = np.cumsum(many) - many
    taken = np.cumsum(length) - np.repeat((np.cumsum(length) - length)[first], many)
    other = (against[order] >= MARGIN) & (taken < MINORITY * np.repeat(np.add.reduceat(size + 1, first), many))
    out = own.astype(np.float64)
    out[order[other]] = 1 - out[order[other]]
    return out


def train(texts: list[str | None], labels: np.ndarray, rounds: int = 80, turns: int = 2, ridge: float = 1.0) -> LineModel:
    """Fit the field by gradient ascent on the likelihood of line labels, which are latent: only documents are labelled.

    The first odds of a line come from its own features alone, with its document's label; line_labels makes labels of them, so steps
    between good and bad lines within a document are seen.  Then the field is fitted and gives the next odds, `turns` times.
    """
    features, size, many = line_features(texts)
    mean, scale = features.mean(axis=0), features.std(axis=0)
    scale[scale < 1e-9] = 1
    x = (features - mean) / scale
    each = np.ones(len(x), np.int64)
    theta = _ascend(x[:, :OWN], np.repeat(labels.astype(np.float64), many), each, rounds, ridge)
    odds = x[:, :OWN] @ theta[:OWN] + theta[OWN]
    for _ in range(turns):
        theta = _ascend(x, line_labels(odds, labels, size, many), many, rounds, ridge)
        model = LineModel(mean, scale, theta[:-5], float(theta[-5]), theta[-4:].reshape(2, 2))
        good = np.clip(model.marginals(features, many), 1e-9, 1 - 1e-9)
        odds = np.log(good / (1 - good))
    odds, line = model.odds(texts), np.zeros(2)
    for _ in range(25):  # Newton steps for the calibration
        p = _sigmoid(line[0] * odds + line[1])
        z = np.stack((odds, np.ones_like(odds)))
        line += np.linalg.solve((z * (p * (1 - p) + 1e-6)) @ z.T + 1e-3 * np.eye(2), z @ (labels - p) - 1e-3 * line)
    model.slope, model.level = max(float(line[0]), 1e-3), float(line[1])
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 2000, max_bytes: int = 20_000, seed: int = 5) -> LineModel:
    """A model from labels(doc_id, quality) of rows that aren't held out.

    Training is on the driver, from a bounded sample: the `sample` labelled documents with the least hashes of doc_id, but for
    those of more than `max_bytes`.  Labels that are null, or whose document isn't there, count for nothing; of several labels of
    one id the least holds.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").where(F.coalesce(F.octet_length("text"), F.lit(0)) <= max_bytes).join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id", F.lit(seed)), "text").limit(sample).select("text", "quality").collect()
    quality = np.array([r.quality for r in rows], np.float64)
    if not 0 < quality.sum() < len(quality):  # one label only: nothing to tell apart
        return LineModel(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 0.0, np.zeros((2, 2)), 1.0, 6.0 if len(quality) == 0 or quality.all() else -6.0)
    return train([r.text for r in rows], quality)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **bounds: int) -> DataFrame:
    """Quality of every whole text of documents(doc_id, text): doc_id, held_out, score and predicted (1 from `threshold` on).

    Only text makes the score.  A null text counts as empty, which has a score of its own; repeated rows score alike; null ids come
    back as null and are not held out.  Without labels of both kinds every score is that of the only kind (good where there are none).
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **bounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                score = model.value.score(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **bounds: int) -> DataFrame:
    """The rows of docs, all columns, whose score reaches the threshold."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **bounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(model.value.score(part.column("text").to_pylist()) >= threshold))

    return docs.mapInArrow(run, docs.schema)
