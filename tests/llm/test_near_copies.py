"""Near copies of the pipeline: every pair from a five-word similarity of 0.8 on, and no other, is linked."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from acreframe.llm import near_copies  # noqa: E402


def _texts() -> list[str | None]:
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdeé世") for _ in range(rng.randint(3, 9)))
    out: list[str | None] = [None, "", "  ", "one two", "One  two", "one two three", "a b c d e", "a b c d e f"]
    common = " ".join(word() for _ in range(30))
    for _ in range(8):
        base = [word() for _ in range(150)]
        for _ in range(14):
            edited = list(base)
            for _ in range(rng.randint(0, 6)):
                edited[rng.randrange(len(edited))] = word()
            out.append(" ".join(edited[: len(edited) - rng.choice([0, 0, 9, 25])]))
    out += [f"{common} " + " ".join(word() for _ in range(rng.randint(0, 9))) for _ in range(40)]
    return out


@pytest.mark.parametrize("crowded, levels, sample", [(16, 2, 16), (1, 1, 1)])
def test_similar_groups(spark, monkeypatch, crowded, levels, sample):
    for name, value in (("CROWDED", crowded), ("LEVELS", levels), ("SAMPLE", sample)):
        monkeypatch.setattr(near_copies, name, value)
    texts = _texts()
    frame = spark.createDataFrame([*enumerate(texts), (None, texts[20]), (None, "no id one"), (None, "no id one")], "doc_id long, text string").repartition(3)
    first = brute.groups([brute.shingles(t) for t in texts], brute.similar)
    assert 40 < len(set(first)) < 100
    got = near_copies.similar_groups(frame).collect()
    assert len(got) == len(texts) + 3
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == dict(enumerate(first))
    assert sorted((r.component_id for r in got if r.doc_id is None), key=str) == sorted([first[20], None, None], key=str)
    if crowded == 1:
        return
    kept = near_copies.drop_similar(frame)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {*first, None}
    assert near_copies.drop_similar(frame.where("false")).count() == 0


def test_stage_drops_edited_copies(spark):
    """Texts of a five-word similarity of 0.8 to 0.9, whose fingerprints differ in more than two bits."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    edited = [w if i not in (40, 90, 120, 150) else "x" for i, w in enumerate(base)]
    other = [w if i % 20 else "y" for i, w in enumerate(base)]
    texts = [" ".join(x) for x in (base, edited, other)]
    assert brute.similar(*map(brute.shingles, texts[:2])) and not brute.similar(*map(brute.shingles, texts[::2]))
    assert (brute.fingerprint(texts[0]) ^ brute.fingerprint(texts[1])).bit_count() > 2
    kept = corpus_pipeline.near_copies(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "")
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2]


def test_sets_meet_ahead_in_the_last_join(spark):
    """Sets of one size meet by places in the first ninth of their shingles, not in the first fifth; none that can be similar is left out."""
    n, percent = 90, 80
    rows = [(h, s, n, i, 9) for s, first in ((1, 0), (2, 0), (3, 11), (4, 11)) for i, h in enumerate(range(first, first + 19))]
    crowded = near_copies._placed(spark.createDataFrame(rows, "h long, id long, n long, i int, k long"), percent)
    met = crowded.join(near_copies._second(crowded), "h").where("id > id2")
    assert {tuple(r) for r in near_copies._pairs(met, percent).collect()} == {(2, 1), (4, 3)}
    # 80 shingles in 100: the smaller set's first may be the larger one's twenty-first
    rows = [(7, 1, 80, 0, 1), (7, 2, 100, 20, 1), (8, 3, 80, 1, 1), (8, 4, 100, 20, 1)]
    crowded = near_copies._placed(spark.createDataFrame(rows, "h long, id long, n long, i int, k long"), percent)
    met = crowded.join(near_copies._second(crowded), "h").where("id > id2")
    assert {tuple(r) for r in near_copies._pairs(met, percent).collect()} == {(2, 1)}


@pytest.mark.parametrize("crowded, dense, levels", [(4, 20, 2), (1, 1, 1)])
def test_groups_beyond_dense_buckets(spark, monkeypatch, crowded, dense, levels):
    for name, value in (("CROWDED", crowded), ("DENSE", dense), ("LEVELS", levels)):
        monkeypatch.setattr(near_copies, name, value)
    texts = _texts()
    first = brute.groups([brute.shingles(t) for t in texts], brute.similar)
    got = near_copies.similar_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(first))


def test_unlike_edits_of_one_text_hardly_meet(spark, monkeypatch):
    """Of pairs that share many shingles, but too few to be similar, a twentieth at most is compared, and none by differences; similar ones meet once a pair."""
    rng = random.Random(10)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    texts = [" ".join(f"x{rng.randrange(10**6)}" if k in edits else w for k, w in enumerate(base)) for edits in (set(rng.sample(range(300), 14)) for _ in range(60))]
    first = brute.groups([brute.shingles(t) for t in texts], brute.similar)
    assert len(set(first)) == len(texts)
    made = []
    write = near_copies.materialise
    monkeypatch.setattr(near_copies, "materialise", lambda df, name, *more: (made.append((name, (out := write(df, name, *more)).count())), out)[1])
    got = near_copies.similar_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(first))
    assert dict(made)["crowded"] > 10 * len(texts)
    assert not [x for x in made if x[0] in ("pairs", "differences", "parts", "far") and x[1] > len(texts) * (len(texts) - 1) / 2 / 20]
    assert not {"differences", "parts", "far"} & {x[0] for x in made}
    # sets of 60 that have 55 and 30 in common with the first: sketches of similar ones differ in 12 bits at most
    sets = [sorted(rng.sample(range(10**12), 60)) for _ in range(2)]
    sets = [sets[0], [*sets[0][:55], *sets[1][:5]], [*sets[0][:30], *sets[1][30:]]]
    bits = [near_copies._sketch(np.array(sorted(x), np.uint64)).tolist() for x in sets]
    rows = [(h, k, 60, i, 13, bits[k], k) for k, x in enumerate(sets) for i, h in enumerate(x[:7])]
    met = near_copies._met_once(spark.createDataFrame(rows, "h long, id long, n long, i int, k long, bits array<long>, label long"), 80)
    assert [tuple(r) for r in met.collect()] == [(1, 0)]


def test_shuffle_files_and_old_stars_go(spark, monkeypatch, tmp_path):
    """A table of the shared folder leaves no shuffle files, and components leave one table."""
    from acreframe.llm import common, components

    paths = iter(tmp_path / str(k) for k in range(99))
    monkeypatch.setattr(components, "table_path", lambda *_: str(next(paths)))
    found = components.components(spark.createDataFrame([(k, k + 1) for k in range(20)], "u long, v long"))
    assert {r.root for r in found.collect()} == {0} and len([p for p in tmp_path.iterdir() if p.is_dir()]) == 1
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles
    before = set(files().mkString("|").split("|"))
    common.materialise(spark.range(1000).repartition(7, "id"), "dealt")
    assert set(files().mkString("|").split("|")) <= before
