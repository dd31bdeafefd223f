"""Plain versions of the training-data operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import xxhash


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def fingerprint(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints: list[int], near) -> list[int]:
    """For each item the index of the first one it is linked with by steps."""
    root = list(range(len(prints)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if near(prints[a], prints[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(x) for x in range(len(prints))]


def shingles(text: str | None) -> frozenset:
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def similar(a: frozenset, b: frozenset) -> bool:
    """Whether a Jaccard similarity is 0.8 at least."""
    return 5 * len(a & b) >= 4 * len(a | b)


def hit_words(text: str | None, items: dict[str, str], window: int = 10) -> tuple[list[bool], set[str]]:
    def words(t: str | None) -> list[str]:
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))

    own, names = words(text), set()
    hit = [False] * len(own)
    for name, item in items.items():
        given = words(item)
        for k in range(max(1, len(given) - window + 1) if given else 0):
            w = given[k : k + window]
            for at in range(len(own) - len(w) + 1):
                if own[at : at + len(w)] == w:
                    names.add(name)
                    hit[at : at + len(w)] = [True] * len(w)
    return hit, names


def removed_bytes(docs: list[tuple[int, str | None]], length: int) -> dict[tuple[int, str | None], tuple[int, int, int, str]]:
    """n_bytes, n_removed, n_spans and digest of each document, by trying every window in order; of one id, texts follow a hash of them."""
    seen, out = set(), {}
    signed = lambda t: (h := xxhash.xxh64_intdigest(t, 42)) - (1 << 64) * (h >> 63)
    for doc, text in sorted(set(docs), key=lambda d: (d[0], signed(d[1] or ""))):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if raw[s : s + length] in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(raw[s : s + length])
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc, text] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def private(text: str | None) -> list[tuple[int, int, int]]:
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        if 12 <= len(digits) <= 19 and sum(v - 9 * (v > 9) for v in doubled) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def _least_run(line: str) -> int:
    """The least hash of the runs of five tokens, or that of all tokens."""
    odd, top = 0x9E3779B97F4A7C15, (1 << 64) - 1
    words = [xxhash.xxh64_intdigest(t) for t in line.encode().split()]
    found = []
    for i in range(max(1, len(words) - 4)):
        h = 0
        for w in words[i : i + 5]:
            h = (h * odd + w) & top
        found.append((h ^ h >> 32) * odd & top)
    return min(found)


def _templates(lines: dict[tuple[str, ...], int], recurs: int, level: int = 2, node: tuple = ()) -> dict[tuple[str, ...], tuple]:
    """Of lines of one length and beginning, each with a number of texts: the group of each that is one of several lines of a recurring template."""
    total, places = sum(lines.values()), Counter()
    if total < recurs or len(lines) < 2:
        return {}
    for x, k in lines.items():
        places.update({(i, t): k for i, t in enumerate(x) if i >= 3 and t != "<*>"})
    places = {p: k for p, k in places.items() if k >= recurs}
    made = defaultdict(list)
    for x in lines:
        m = tuple(t if i < 3 or t == "<*>" or places.get((i, t), 0) >= max(1, 0.3 * total) else None for i, t in enumerate(x))
        if m.count(None) <= 0.4 * (len(m) - 3) and len(m) - m.count(None) - m.count("<*>") >= 0.6 * len(m):
            made[m].append(x)
    out = {x: ("template", node, m) for m, same in made.items() if len(same) > 1 and sum(lines[x] for x in same) >= recurs for x in same}
    at = defaultdict(list)
    for (i, _), k in places.items():
        at[i].append(k)
    best = max(((sum(ks), -len(ks), -i) for i, ks in at.items() if max(ks) < total), default=None)
    if level and best:
        i, under = -best[2], defaultdict(dict)
        for x, k in lines.items():
            if x not in out:
                under[x[i] if (i, x[i]) in places else None][x] = k
        for token, own in under.items():
            out |= _templates(own, recurs, level - 1, (*node, i, token))
    return out


def boilerplate(texts: list[str | None], recurs: int = 3) -> list[set[int]]:
    """Numbers of the lines of each text that recur, as they read or as a template, in texts that are otherwise their own."""

    def read(line: str) -> tuple[str, ...]:
        return tuple("<*>" if re.search("[0-9@]|://", t) else t for t in line.encode().decode("latin-1").split())

    parsed = {t: [(at, read(x), len(x.encode())) for at, x in enumerate(t.split("\n")) if x.encode().split()] for t in {t or "" for t in texts}}
    holders = defaultdict(set)
    for t, lines in parsed.items():
        for _, line, _ in lines:
            holders[line].add(t)
    leaf = lambda line: (len(line), line[:3])
    leaves = defaultdict(set)
    for line, ts in holders.items():
        leaves[leaf(line)] |= ts
    words = lambda line: len(line) - line.count("<*>")
    group = {x: (x,) for x in holders if len(holders[x]) >= recurs and words(x) >= 0.6 * len(x)}
    same_leaf = defaultdict(dict)
    for x in holders:
        if len(leaves[leaf(x)]) >= recurs and len(x) > 3:
            same_leaf[leaf(x)][x] = len(holders[x])
    for lines in same_leaf.values():
        group |= _templates(lines, recurs)
    running, lengths = Counter(), Counter()
    for t in texts:
        for x in (t or "").encode().decode("latin-1").split("\n"):
            lengths[len(x.split())] += 1
            running.update(x.split() if len(x.split()) > 3 else ())

    def chance(line: tuple[str, ...]) -> float:
        e = lengths[len(line)]
        for t in line:
            if t != "<*>":
                w = t.encode("latin-1").decode()
                w = w.strip(".,").lower() or w
                forms = {x + end for x in (w, w.capitalize()) for end in ("", ".", ",")} | {t.encode("latin-1").decode()}
                e *= (sum(running[x.encode().decode("latin-1")] for x in forms) + 1) / (running.total() + 1)
        return e

    runs = defaultdict(set)
    for t in parsed:
        for line in t.split("\n"):
            runs[_least_run(line)].add(t)
    n = Counter()
    for t, lines in parsed.items():
        raw = t.split("\n")
        first = {x: raw[at] for at, x, _ in reversed(lines)}  # of lines that read alike the first one's run counts
        for line in {x for _, x, _ in lines if x in group}:
            rest = [(x, b) for _, x, b in lines if x != line]
            own = sum(b for x, b in rest if len(runs[_least_run(first[x])]) < recurs)
            n[group[line]] += own > 0 and 2 * own >= sum(b for _, b in rest)
    odd = lambda k, e: k >= 10 * e and k * (math.log(k / e) - 1) + e >= 20
    gone = {x for x, g in group.items() if n[g] >= recurs and (len(x) > 3 or odd(n[g], chance(x)))}
    return [{at for at, line, _ in parsed[t or ""] if line in gone} for t in texts]


def best_cost(places: list[int], costs: list[int], width: int, each: int) -> float:
    best = [0.0] + [float("inf")] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            n = places[j] - places[i]
            if n <= width:
                best[j] = min(best[j], best[i] + (0 if n & (n - 1) == 0 else width - n) + costs[j] + each)
    return best[-1]


def marginals(score: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Probability of label 1 at each place of a chain, over all labellings."""
    total, ones = 0.0, np.zeros(len(score))
    for labels in product((0, 1), repeat=len(score)):
        w = np.exp(sum(s * y for s, y in zip(score, labels, strict=True)) + sum(move[a, b] for a, b in zip(labels, labels[1:], strict=False)))
        total += w
        ones += w * np.array(labels)
    return ones / total
