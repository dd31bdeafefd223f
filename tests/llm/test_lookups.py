"""URL rules, collocations and clusters, against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from acreframe.llm import centroids, collocations, queries, url_rules
from acreframe.llm.quotient_filter import Counted, decode, encode, permute, restore

SF = "/root/testdata/sf0.001"
TABLES = {"op11_url_rules": "pages", "op12_collocations": "documents", "op13_clusters": "embeddings"}


@pytest.mark.parametrize("name", sorted(TABLES))
def test_queries_against_sql(spark, name):
    got = queries.QUERIES[name](spark, SF)
    con = duckdb.connect()
    con.execute(f"create view {TABLES[name]} as select * from '{SF}/{TABLES[name]}.parquet'")
    found = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(got.columns)
    rows = sorted(map(tuple, got.select(*columns).collect()), key=str)
    assert rows and rows == sorted(found.fetchall(), key=str)


# URL rules


def _fits(pattern: str, host: str, path: str) -> bool:
    """A pattern's meaning, told without tokens."""
    start = "||" if pattern.startswith("||") else "|" if pattern.startswith("|") else ""
    body = pattern[len(start) :]
    end = body.endswith("|")
    body = body[:-1] if end else body
    target = host + path
    starts = range(len(target) + 1) if not start else [0] if start == "|" else [0, *(i + 1 for i, c in enumerate(host) if c == ".")]

    def matches(i: int, j: int) -> bool:
        if j == len(body):
            return not end or i == len(target)
        if body[j] == "*":
            return any(matches(k, j + 1) for k in range(i, len(target) + 1))
        if body[j] == "^":
            if i == len(target):
                return matches(i, j + 1)
            return not re.match(r"[0-9A-Za-z_\-.%]", target[i]) and matches(i + 1, j + 1)
        return i < len(target) and target[i] == body[j] and matches(i + 1, j + 1)

    return any(matches(i, 0) for i in starts)


def _judged(url: str | None, rules: list[url_rules.Rule]) -> tuple:
    _, sep, rest = (url or "").partition("://")
    rest = rest if sep else ""
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if _fits(r.pattern, host, path)]
    sites = sorted((r for r in fits if r.site), key=lambda r: (len(r.name), r.action == "allow", r.name))
    if sites:
        return host, path, sites[-1].name, sites[-1].action
    return host, path, None, "block" if fits and not any(r.action == "allow" for r in fits) else "allow"


@pytest.mark.parametrize("chars", [1 << 20, 40])
def test_urls(spark, monkeypatch, chars):
    monkeypatch.setattr(url_rules, "RULE_CHARS", chars)
    rng = random.Random(3)
    part = lambda: "".join(rng.choice(["ab", "c", "1", "-", ".", "/", "é", "AB", "%2"]) for _ in range(rng.randint(1, 5)))
    urls = [f"http{rng.choice(['', 's'])}://{part()}.{rng.choice(['org', 'Com', 'net'])}{rng.choice(['', '/', '/ab/', '/c/1'])}{part()}{rng.choice(['', '?q=/ab', '#x', '/'])}" for _ in range(250)]
    urls += [None, "", "no scheme", "://", "x://y://z/ab/", "http://a.org", "http://a.org/" + "ab/" * 90, "line\nbreak://h.org/a\nb/c"]
    rules = [*url_rules.SITES, *url_rules.PATTERNS, url_rules.site_rule("block", "ab.com/"), url_rules.site_rule("allow", "com/c/1"), url_rules.site_rule("block", "org/")]
    rules += [url_rules.pattern_rule(x) for x in ("ab", "||c.", "^ab^", "@@/c/*ab|", "|ab*1|", "1^", "@@*c-1*", "%2^", "||ab*é", "c|", "AB")]
    pages = spark.createDataFrame([*((i, u, "b", "y") for i, u in enumerate(urls)), (None, "http://ab.com/x", "b", "y"), (3, urls[3], "b", "y")], "page_id long, url string, `Host` string, `rule` string").repartition(3)
    out = url_rules.judge_urls(pages, rules)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "pattern", "verdict", "tried"]
    got = out.collect()
    assert len(got) == len(urls) + 2
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == _judged(r.url, rules), r.url
        assert (r.pattern is None) == (r.rule is not None or not any(_fits(x.pattern, r.host, r.path) for x in rules if not x.site))
    assert sum(r.tried for r in got) < 0.6 * len(rules) * len(got)
    assert url_rules.judge_urls(pages.where("false"), rules).count() == 0
    assert {r.verdict for r in url_rules.judge_urls(pages, []).collect()} == {"allow"}


def test_rarest_token(spark):
    """Of many rules a URL runs those only whose rarest token it has."""
    rules = [url_rules.pattern_rule(f"||shop{i}.com/ads/") for i in range(300)]
    pages = spark.createDataFrame([(i, f"http://shop{i}.com/ads/x") for i in range(200)] + [(i, "http://other.com/ads/") for i in range(300)], "page_id long, url string")
    got = url_rules.judge_urls(pages, rules).collect()
    assert all(r.tried == (1 if "shop" in r.url else 0) and r.verdict == ("block" if "shop" in r.url else "allow") for r in got)
    counts = {"shop1": 1, "com": 9, "ads": 9}
    assert url_rules.rule_index(rules[1:2], counts) == {"shop1": [0]}
    assert url_rules.literal_tokens(url_rules.pattern_rule("ab.cd*ef.gh")) == set()
    assert url_rules.literal_tokens(url_rules.pattern_rule("||ab.cd*ef.gh|")) == {"ab", "gh"}


# Collocations


@pytest.mark.parametrize("bits", [1, 20, 40, 60, 63])
def test_quotient_filters(bits):
    rng = np.random.default_rng(bits)
    keys = rng.integers(0, 1 << bits, 3000, dtype=np.uint64)
    mixed = permute(keys, bits)
    assert (restore(mixed, bits) == keys).all() and int(mixed.max()) >> bits == 0
    values = np.concatenate([mixed, np.repeat(mixed[:2], 700)])
    parts = [Counted.of(x) for x in np.array_split(values, 5)] + [Counted.of(values[:0])]
    back = [decode(encode(p, bits)) for p in parts]
    merged = back[0].merged(*back[1:])
    assert dict(zip(merged.values.tolist(), merged.counts.tolist(), strict=True)) == Counter(values.tolist())
    assert (np.diff(merged.values.astype(object)) > 0).all()
    if bits == 60:
        assert len(encode(merged, bits)) < 9 * len(merged.values)


def _phrases(docs, longest, least, share, first):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in f.items():
        found, some = [], [p for p, a in own.items() if len(p) > 1 and a >= least]
        for p in some:
            a = own[p]
            if any(len(q) > len(p) and 100 * own[q] >= share * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q in some):
                continue
            score, _, le, r = min((1000000 * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), le, r))
        out += [(lang, i, p.decode(), -a, le, r, n[lang], -s) for i, (s, a, p, le, r) in enumerate(sorted(found)[:first], 1)]
    return sorted(out)


@pytest.mark.parametrize("bits, longest, first", [(20, 3, 2000), (4, 3, 7), (3, 4, 50)])
def test_collocations(spark, monkeypatch, bits, longest, first):
    for name, value in (("HELD", 50), ("PLACES", 100), ("WORDS", 30), ("SPLIT_BYTES", 200), ("PARTS", 3)):
        monkeypatch.setattr(collocations, name, value)
    rng = random.Random(bits)
    words = ["the", "The", "of", "New", "York", "a\u00e9", "\u4e16", "x-1", "İ", "\u00a0", "and"]
    docs = [(rng.choice(["en", "en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice(["  ", " ", " ", " ", "\t", ". ", "\n", "\x0b", "!"]) for _ in range(rng.randint(0, 60)))) for _ in range(120)]
    docs += [(None, None), ("en", ""), ("en", "new york city " * 400), (None, "new york " * 12), ("de", "?!..")] + [docs[0]] * 5
    frame = spark.createDataFrame([(i, t, g, "x", -1) for i, (g, t) in enumerate(docs)], "doc_id long, text string, lang string, n string, phrase int").repartition(3)
    got = collocations.collocations(frame, longest=longest, least=10, share=50, first=first, bits=bits)
    assert sorted(map(tuple, got.collect())) == _phrases(docs, longest, 10, 50, first)
    assert collocations.collocations(frame.where("false")).count() == 0


def test_scores_beyond_64_bits(spark):
    """Counts whose products pass 64 bits are multiplied and divided exactly."""
    a, le, r = 3 * 10**9 + 1, 3 * 10**9 + 7, 3 * 10**9 + 11
    counts = spark.createDataFrame([("en", "x", le, 1), ("en", "y", r, 1), ("en", "x y", a, 2)], "lang string, phrase string, n long, size int")
    row = collocations._scored(collocations._lasting(counts.where("size > 1"), 50), counts, 3).first()
    assert row.score == 1000000 * a * a // (le * r)


# Clusters


def _kmeans(rows, clusters, rounds, seed):
    kept = [(i, [math.floor(256 * x) for x in e]) for i, e in rows if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    hashed = sorted(kept, key=lambda v: (v[0] is None, hashlib.sha256(f"{seed}:{v[0]}".encode()).hexdigest()))
    cents = [v for _, v in hashed[:clusters]]
    vectors, cents = np.array([v for _, v in kept]), np.array(cents)
    for turn in range(rounds + 1):
        far = np.stack([((vectors - c) ** 2).sum(1) for c in cents], 1)
        of = [int(min(range(len(cents)), key=lambda c: (row[c], c))) for row in far.tolist()]
        if turn < rounds:
            cents = np.array([[sum(x) // len(x) for x in zip(*own, strict=True)] if len(own := vectors[np.array(of) == c].tolist()) else cents[c].tolist() for c in range(len(cents))])
    own = [int(far[i, c]) for i, c in enumerate(of)]
    inertia = Counter()
    for d, c in zip(own, of, strict=True):
        inertia[c] += d
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents.tolist()]
    return sorted(((i, c, d, inertia[c], inertia.total(), name[c]) for (i, _), c, d in zip(kept, of, own, strict=True)), key=str)


@pytest.mark.parametrize("clusters, spread", [(7, 0.2), (40, 0.02), (500, 0.3)])
def test_clusters(spark, clusters, spread):
    rng = np.random.default_rng(clusters)
    middles = rng.normal(0, 1, (9, 64))
    vectors = (middles[rng.integers(0, 9, 300)] + rng.normal(0, spread, (300, 64))).tolist()
    rows = list(enumerate(vectors)) + [(i, vectors[5]) for i in range(1000, 1100)] + [(2000, None), (2001, [1.0] * 63), (2002, [1.0] * 63 + [None]), (2003, [1.0] * 63 + [float("nan")]), (2004, [1.0] * 63 + [float("-inf")]), (7, vectors[7]), (None, vectors[8])]
    frame = spark.createDataFrame([(i, v, 1, b"x", 2) for i, v in rows], "vec_id long, embedding array<double>, label int, digest binary, cluster int").repartition(4)
    report: list[int] = []
    got = centroids.cluster_vectors(frame, clusters, 5, 64, 2, report)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == _kmeans(rows, clusters, 5, 2)
    assert len(report) == 6 and report[0] == 300
    if spread == 0.2:
        assert report[-1] < 150
    assert centroids.cluster_vectors(frame.where("vec_id > 1999")).count() == 0


def test_loosened_bounds_hold():
    """No point of a sphere comes nearer than the bound says, which is less than the full drift where the sphere lies aside."""
    rng = np.random.default_rng(0)
    old = rng.normal(0, 5, (12, 4))
    new, radius = old + rng.normal(0, 1, old.shape), rng.uniform(0, 3, 12)
    bound = centroids.loosened(old, new, radius)
    for i in range(12):
        points = rng.normal(0, 1, (4000, 4))
        points = old[i] + radius[i] * points / np.linalg.norm(points, axis=1)[:, None] * rng.uniform(0, 1, (4000, 1)) ** 0.25
        others = [j for j in range(12) if j != i]
        nearer = max((np.linalg.norm(points - old[j], axis=1) - np.linalg.norm(points - new[j], axis=1)).max() for j in others)
        assert nearer <= bound[i]
    assert (bound < np.linalg.norm(new - old, axis=1).max() * 0.999).any()


def test_exact_distances():
    rng = np.random.default_rng(1)
    for most in (100, 1 << 26):
        x, c = rng.integers(-most, most, (20, 64)), rng.integers(-most, most, (5, 64))
        assert centroids.squared(x, c).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, w, strict=True)) for w in c] for v in x]
