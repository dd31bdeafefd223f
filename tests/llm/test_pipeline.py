"""Each stage of the pipeline on its own input, against plain versions."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from acreframe.llm import line_crf  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    items = {str(r.item_id): r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()} if "text" in docs.columns else {}
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        good = {r.doc_id for r in line_crf.score_documents(docs, labels).where("predicted = 1").collect()} if name == "quality" else set()
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()} if name != "packing" else docs.collect()
        if name == "quality":
            assert kept[name] == {i: t for i, t in before.items() if i in good} and len(good) < len(before)
        elif name == "lines":
            ids = sorted(before)
            drop = brute.boilerplate([before[i] for i in ids])
            assert kept[name] == {i: "\n".join(x for k, x in enumerate(before[i].split("\n")) if k not in d) for i, d in zip(ids, drop, strict=True)}
        elif name == "near_copies":
            ids = sorted(before)
            first = brute.groups([brute.shingles(before[i]) for i in ids], brute.similar)
            assert kept[name] == {ids[g]: before[ids[g]] for g in set(first)}
        elif name == "benchmark":
            assert kept[name].keys() == before.keys()
            hits = {i: any(brute.hit_words(t, items)[0]) for i, t in before.items()}
            assert all((kept[name][i] != before[i]) == hits[i] for i in before) and any(hits.values())
            assert not any(any(brute.hit_words(t, items)[0]) for t in kept[name].values())
        else:
            assert {p.doc_id for p in kept[name]} == before.keys()
    assert corpus_pipeline.run(spark, SF).count() == len(kept["packing"])


def test_stages_on_odd_rows(spark):
    """Nulls, empty and repeated rows, and no rows at all; near copies have tests of their own."""
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(None, None, "en", "a", None), (1, "", None, "a", 0), (1, "", None, "a", 0), (2, None, "en", None, 3), (3, "word of a text " * 3000, "en", "a", 45000), (3, "another text", "en", "a", 12)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        if name == "near_copies":
            continue
        out = stage(spark, docs, SF)
        if name == "packing":
            assert sorted({p.doc_id for p in out.collect()}, key=str) == [1, 2, 3, None]
        else:
            assert out.columns == docs.columns and out.count() <= len(rows) and (name == "quality" or out.count() == len(rows))
        assert stage(spark, docs.where("false"), SF).count() == 0
