"""The training-data operators against plain versions, with nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import hashlib
import io
import itertools
import random
from collections import Counter
import re
import sys
import wave
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from acreframe.llm import decontaminate as de  # noqa: E402
from acreframe.llm import fm_index, line_crf, packing, sanitise, simhash, suffix_index, telephony, templates, token_tree, warc  # noqa: E402
from acreframe.llm.common import materialise  # noqa: E402
from acreframe.llm.queries import tokenizer  # noqa: E402

SF = "/root/testdata/sf0.001"
PHRASE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from a tall oak"


def _texts() -> list[str | None]:
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeéß世") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    long = "\n".join(prose(30) for _ in range(60))
    base = prose(80)
    out: list[str | None] = [None, "", " ", "one", "Two words", long, long, base, base, base.replace(" ", "  ", 1), base[:-5] + "end.", "aB" * 150, "x" * 5000]
    out += [prose(20) + "\n" + PHRASE.upper() + "!\n" + prose(5), PHRASE, PHRASE[10:60], "seven wise", prose(12) + "\nPage 3 of the public report on owls\n" + prose(10)]
    out += [f"{prose(15)}\nPage {i} of the public report on {word()}\n{prose(9)} Mail a.b{i}@mail.example.org or +1 (555) 010-99{i:02d}, 10.0.{i}.255, 4111 1111 1111 1111." for i in range(12)]
    return out


@pytest.fixture(scope="module")
def rows():
    texts = _texts()
    given = [(i * 3, t) for i, t in enumerate(texts)]
    return [*given, (9, "one"), (None, base_text()), (None, None)]


def base_text() -> str:
    return _texts()[7]


@pytest.fixture(scope="module")
def docs(spark, rows):
    """With columns whose names the operators use themselves."""
    made = [(t, i, "k", "raw", 1, "z", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(made, "text string, doc_id long, key string, raw string, __key int, lines string, n_chars long").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def by_id(df) -> dict:
    return {r.doc_id: r for r in df.collect() if r.doc_id is not None}


def test_telephony(docs, empty, rows):
    out = by_id(telephony.decode_media(telephony.store_media(docs)))
    for i, t in rows:
        if i is not None:
            raw = (t or "").encode()
            payload = raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw))
            r = out[i]
            assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
            assert r.media_bytes > r.payload_bytes
    assert telephony.decode_media(telephony.store_media(docs)).count() == len(rows)
    assert telephony.decode_media(telephony.store_media(empty)).count() == 0
    assert list(telephony.ULAW[[0, 127, 128, 255]]) == [-32124, 0, 32124, 0] and list(telephony.ALAW[[0x55, 0xD5, 0x2A]]) == [-8, 8, -32256]


def test_telephony_files(spark, rows):
    """Each stored file and its PCM against a plain reading: WAV by the standard library, tables and resampling sample by sample."""
    frame = spark.createDataFrame([r for r in rows if r[0] is not None], "doc_id long, text string")
    stored = materialise(telephony.store_media(frame), "media", compression="zstd")
    files = {r.doc_id: r.media for r in stored.collect()}
    seen = set()
    for r in telephony.decode_media(stored, with_pcm=True).collect():
        media, codec = files[r.doc_id], r.feature.split(";")[0]
        seen.add(codec)
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest()) and media[:4] == b"RIFF" and int.from_bytes(media[4:8], "little") == len(media) - 8
        payload = media[media.index(b"data") + 8 :]
        assert hashlib.sha256(payload).hexdigest() == r.payload_sha256 and media[media.index(b"data") + 4 :][:4] == len(payload).to_bytes(4, "little")
        if codec == "adpcm":
            pcm = np.concatenate([telephony.decode_adpcm(np.frombuffer(payload[k : k + 64], np.uint8)[None])[0] for k in range(0, len(payload), 64)])
        else:
            pcm = np.array([_g711(codec, b) for b in payload], np.int16)
        with wave.open(io.BytesIO(bytes(r.pcm).replace(b"fact\x04\0\0\0" + (2 * len(pcm)).to_bytes(4, "little"), b"", 1))) as wav:
            assert (wav.getframerate(), wav.getsampwidth(), wav.getnchannels(), wav.getnframes()) == (16000, 2, 1, 2 * len(pcm))
            out = np.frombuffer(wav.readframes(wav.getnframes()), "<i2")
        assert (r.pcm_bytes, r.pcm_sha256) == (len(r.pcm), hashlib.sha256(r.pcm).hexdigest()) and (out[::2] == pcm).all()
        weights = np.array([np.sinc(k - 7.5) * (0.5 + 0.5 * np.cos(np.pi * (k - 7.5) / 8)) for k in range(16)])
        for i in {0, 1, len(pcm) // 2, len(pcm) - 1}:
            near = [float(pcm[i - 7 + k]) if 0 <= i - 7 + k < len(pcm) else 0.0 for k in range(16)]
            assert abs(out[2 * i + 1] - np.clip(np.dot(near, weights / weights.sum()), -32768, 32767)) <= 0.51
        wide = out.astype(float)
        cross = sum((a < 0) != (b < 0) for a, b in zip(out, out[1:], strict=False))
        assert r.feature == f"{codec};rate=16000;samples={len(out)};peak={int(np.abs(wide).max())};rms={int(np.sqrt(np.mean(wide**2)))};crossings={cross * 1000 // len(out)}"
    assert seen == set(telephony.CODECS)


def _g711(codec: str, byte: int) -> int:
    """A sample by the definition of the coding, bit by bit."""
    if codec == "ulaw":
        byte ^= 0xFF
        size = ((((byte & 15) << 1) + 33) << (byte >> 4 & 7)) - 33 << 2
        return -size if byte & 128 else size
    byte ^= 0x55
    step, low = byte >> 4 & 7, byte & 15
    size = (2 * low + 1) << 3 if step == 0 else (2 * low + 33) << (step + 2)
    return size if byte & 128 else -size


def test_adpcm_by_samples():
    blocks = np.random.default_rng(0).integers(0, 256, (9, 64), dtype=np.uint8)
    for block, got in zip(blocks, telephony.decode_adpcm(blocks), strict=True):
        s = int(np.array(block[:2]).view("<i2")[0])
        i, want = min(int(block[2]), 88), [s]
        for byte in block[4:]:
            for code in (int(byte) & 15, int(byte) >> 4):
                step = int(telephony._STEPS[i])
                move = (step >> 3) + (step if code & 4 else 0) + (step >> 1 if code & 2 else 0) + (step >> 2 if code & 1 else 0)
                s = max(-32768, min(32767, s - move if code & 8 else s + move))
                i = max(0, min(88, i + [-1, -1, -1, -1, 2, 4, 6, 8][code & 7]))
                want.append(s)
        assert got.tolist() == want


def test_private_spans(docs, empty, rows):
    out = by_id(sanitise.find_private(docs))
    kinds = ("email", "ip", "card", "phone")
    for i, t in rows:
        if i is not None:
            want = brute.private(t)
            text = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in want)
            assert out[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
            assert set(text.split(",")) - {""} <= set(out[i].spans.split(","))
            assert [out[i][f"n_{k}"] for k in kinds] == [sum(s[1] == n for s in want) for n in range(4)]
    assert sanitise.find_private(empty).count() == 0
    rng = random.Random(1)
    for _ in range(3000):
        t = "".join(rng.choice("ab.@1204 -+()é%") for _ in range(rng.randint(0, 30)))
        assert [(a, k, b) for a, k, b, _ in sanitise.base_spans(t)] == brute.private(t), t


def test_private_counts(spark):
    """Counts of each kind where the spans of a text aren't one of each kind in the order of kinds."""
    rows = [(1, "a@b.c"), (2, "1.2.3.4 and 5.6.7.8, 9.9.9.9"), (3, "+1 (555) 010-9900 then 4111 1111 1111 1111 then x@y.org, 1.2.3.4"), (4, "4111-1111-1111-1111"), (5, "none"), (6, None)]
    out = by_id(sanitise.find_private(spark.createDataFrame(rows, "doc_id long, text string")))
    for i, t in rows:
        assert [out[i][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[1] == n for s in brute.private(t)) for n in range(4)], t


def test_disclosing_terms(spark):
    """Shares against counts by hand; terms that give a kind or a value away go, wherever they stand in the texts that hold it."""
    far = " ".join(["filler"] * 40)
    rows = [(i, f"Doctor Zebulon wrote to zeb@clinic.org about common things {'abcdefghi'[i] * 4} {far} and zebulon again") for i in range(9)]
    rows += [(10 + i, "Doctor wrote about common filler things " + "xyzw"[i % 4] * 5 + f" number {i}") for i in range(90)]
    rows += [(100 + i, rows[0][1]) for i in range(50)] + [(200, "Call other@mail.org"), (201, "Zebulon without a kind of value")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {(r.entity, r.term): r for r in sanitise.disclosures(docs, sanitise.entities(docs)).collect()}
    texts = {t for _, t in rows}
    words = {t: {w for w in re.findall("[a-z]{3,}", re.sub("[a-z]+@[a-z.]+", " ", t.lower()))} for t in texts}
    want = {}
    for value in ("", "zeb@clinic.org", "other@mail.org"):
        own = {t for t in texts if (value or "@") in t}
        for w in set().union(*words.values()):
            near = {t for t in own if w in words[t]} if not value else {t for t in own if w in (re.findall("[a-z]{3,}", t.lower().split(value)[0])[-8:] + re.findall("[a-z]{3,}", t.lower().split(value)[1])[:8])}
            if len(near) >= 3:
                rate, n = len(own) / len(texts), max(len(near), sum(w in words[t] for t in texts))
                share = np.log((len(near) + 3 * rate) / (n + 3) / rate) / -np.log(rate)
                if share >= 0.7:
                    want[sanitise._entity(0, value), w] = (share, 5 if share >= 0.9 else 4)
    assert found.keys() == want.keys() and all(abs(found[k].share - v[0]) < 1e-9 and found[k].kind == v[1] for k, v in want.items())
    assert "zebulon" in {w for _, w in want} and not {w for _, w in want} & {"doctor", "common", "things", "wrote", "about", "filler"}
    out = sanitise.find_private(docs).collect()
    for r in out:
        text = dict(rows)[r.doc_id]
        extra = {(a, b) for k, a, b in (x.split(":") for x in r.spans.split(",") if x) if k in ("generalise", "remove")}
        assert extra == ({(str(m.start()), str(m.end())) for _, w in want for m in re.finditer(rf"\b{w}\b", text.lower())} if "zeb@" in text else set())
    clean = {r.doc_id: r.text for r in sanitise.sanitise(docs).collect()}
    assert "ebulon" not in clean[0] and "[EMAIL]" in clean[0] and "common things" in clean[0] and clean[10] == rows[9][1] and clean[201] == rows[-1][1]


def test_private_rows_of_one_id(spark):
    """Rows that share an id but not a text each get their own spans."""
    rows = [(0, f"Doctor Zebulon wrote to zeb@clinic.org {w}") for w in ("one", "two", "three")] + [(0, "hi"), (0, "hi"), (None, "hi"), (0, None)] + [(i, f"text number {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = sanitise.find_private(docs).collect()
    assert len(out) == len(rows) and sum("remove" in r.spans or "generalise" in r.spans for r in out) == 3 and sum(r.spans == "" for r in out) == len(rows) - 3
    clean = [r.text for r in sanitise.sanitise(docs).collect()]
    assert sorted(filter(None, clean)) == sorted([t for _, t in rows if t and "@" not in t] + [t for t in clean if t and "[EMAIL]" in t]) and sum("[EMAIL]" in (t or "") for t in clean) == 3


def test_warc(spark):
    pages = [(5, "http://a", "x" * 200), (3, None, "x" * 200), (9, "http://b\nc", "x" * 200), (1, "u", "short"), (2, "u", "short"), (4, "u", None), (6, "u", ""), (7, "é" * 20000, "é" * 60000), (8, "u", "é" * 60000), (None, "u", "x" * 200), (3, None, "x" * 200)]
    frame = spark.createDataFrame([(u, h, p, "c") for p, u, h in pages], "url string, html string, page_id long, digest string").repartition(2)
    got = sorted(map(tuple, warc.archive_pages(frame).collect()), key=str)
    want = []
    for p, _, h in pages:
        raw = (h or "").encode()
        least = min(q for q, _, g in pages if q is not None and g == h)
        again = len(raw) >= 100 and p is not None and p != least
        want.append((p, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", least if again else None))
    assert got == sorted(want, key=str)
    assert warc.archive_pages(frame.where("false")).count() == 0
    records = [warc.record(i, "u", b"abc" * i, hashlib.sha256(b"abc" * i).hexdigest(), None) for i in range(300)]
    archive = warc.write_archive(records)
    assert list(warc.read_archive(archive)) == records and archive[:4] == b"\x5d\x2a\x4d\x18"
    with pytest.raises(ValueError):
        list(warc.read_archive(archive[:-3]))


def test_warc_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    want = sorted(con.execute(warc.ARCHIVED_SQL).fetchall(), key=str)
    assert sorted(map(tuple, warc.archive_pages(spark.read.parquet(f"{SF}/pages.parquet")).collect()), key=str) == want


def test_templates(spark, docs, empty, rows):
    frame = spark.createDataFrame([r for r in rows if r[0] is not None], "doc_id long, text string").dropDuplicates(["doc_id"])
    more = spark.read.parquet(f"{SF}/documents.parquet").select((F.col("doc_id") + 1000).alias("doc_id"), "text")
    both = frame.union(more).orderBy("doc_id").collect()
    want = brute.boilerplate([r.text for r in both])
    assert sum(map(len, want)) > 10
    got = by_id(templates.line_report(frame.union(more)))
    for r, lines in zip(both, want, strict=True):
        kept = "\n".join(x for i, x in enumerate((r.text or "").split("\n")) if i not in lines)
        assert (got[r.doc_id].n_dropped, got[r.doc_id].kept_sha256) == (len(lines), hashlib.sha256(kept.encode()).hexdigest())
    kept = templates.drop_boilerplate(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    assert all("public report" not in (r.text or "") for r in kept.where("doc_id > 51").collect())
    assert templates.line_report(empty).count() == 0


def _dropped(spark, texts: list[str]) -> list[int]:
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = by_id(templates.line_report(frame))
    want = brute.boilerplate(texts)
    assert [got[i].n_dropped for i in range(len(texts))] == [len(x) for x in want]
    return [got[i].n_dropped for i in range(len(texts))]


def test_templates_keep_copies(spark):
    """Groups of copies and near copies aren't boilerplate, whatever their number; what they share with other texts is."""
    text = "Some words that stand in a text of its own\nand a second line that has its own words\nand a third one of some length"
    assert not any(_dropped(spark, [text + (f"\nand number {i} at the end" if i % 5 == 0 else "") + ("\n" + "abcdefgh"[i % 8] * 9) for i in range(200)]))
    foot = "Terms of use apply"
    rng = random.Random(12)
    other = [" ".join(rng.choice("abcdefghij") * rng.randint(2, 9) for _ in range(12)) + "\n" + foot for _ in range(20)]
    assert _dropped(spark, [f"{text}\n{foot}"] * 60 + other) == [1] * 80


def test_templates_over_a_small_vocabulary(spark):
    """Unlike texts that share all their words, each with a licence line and a short one; and a template with a field."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60)]
    prose = lambda: "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(8, 14))) for _ in range(5))
    texts = [f"{prose()}\nLicensed under the terms of the General Public License\n{prose()}\nAll rights reserved\nWritten and sent by {rng.choice(words)} {i} on a fine day in spring" for i in range(300)]
    assert _dropped(spark, texts) == [3] * 300
    assert not any(_dropped(spark, [prose() for _ in range(100)]))


def _own_prose(rng: random.Random, lines: int = 3) -> str:
    return "\n".join(" ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(4, 9))) for _ in range(rng.randint(8, 12))) for _ in range(lines))


def test_templates_many_short_lines(spark):
    """However many short lines recur, each goes; short lines of common words stay, though chance repeats them in unlike texts."""
    rng = random.Random(14)
    word = lambda: "".join(rng.choice("klmnopqrst") for _ in range(6))
    feet = [" ".join(word() for _ in range(rng.choice([1, 2, 3]))) for _ in range(60)]
    texts = [f"{_own_prose(rng)}\n{feet[i % 60]}" for i in range(1200)]
    assert _dropped(spark, texts) == [1] * 1200
    common = [word() for _ in range(12)]
    line = lambda k: " ".join(rng.choice(common) for _ in range(k))
    prose = [f"{_own_prose(rng)}\n{line(9)}\n{line(rng.randint(1, 3)).capitalize()}.\n{line(8)}" for _ in range(300)]
    assert max(Counter(t.split("\n")[4] for t in prose).values()) > 3 and not any(_dropped(spark, prose))


@pytest.mark.parametrize("many", [1, 3, 6, 40])
def test_templates_many_in_a_leaf(spark, many):
    """Lines of one length and beginning may be of any number of templates, each with a field."""
    rng = random.Random(many)
    word = lambda: "".join(rng.choice("klmnopqrst") for _ in range(6))
    made = []
    for _ in range(many):
        rest, field = [word() for _ in range(6)], rng.randrange(6)
        made.append(lambda rest=rest, field=field: " ".join(["Sent", "from", "the", *(word() if i == field else w for i, w in enumerate(rest))]))
    texts = [f"{_own_prose(rng)}\n{made[i % many]()}" for i in range(30 * many if many < 40 else 400)]
    assert _dropped(spark, texts) == [1] * len(texts)


def test_templates_rows_of_one_id(spark):
    """A row loses the lines of its own text only."""
    rng = random.Random(13)
    own = ["\n".join(" ".join("".join(rng.choice("abcde") for _ in range(6)) for _ in range(9)) for _ in range(2)) for _ in range(12)]
    rows = [(i, f"{t}\nThe same line stands in many texts") for i, t in enumerate(own[:8])] + [(3, "first own line that stays\nand a second one\nand the third own line"), (3, own[9]), (None, own[10]), (3, None)]
    got = templates.drop_boilerplate(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r.doc_id, r.text) for r in got if r.text and r.doc_id is not None) == sorted([(i, t) for i, t in enumerate(own[:8])] + rows[8:10])
    assert len(got) == len(rows) and {r.text for r in got if r.doc_id is None} == {own[10]}


def test_field_marginals():
    rng = np.random.default_rng(2)
    for n in (1, 2, 5):
        move, weight = rng.normal(size=(2, 2)), rng.normal(size=3)
        features, many = rng.normal(size=(2 * n + 1, 3)), np.array([n, n + 1])
        model = line_crf.LineModel(np.zeros(3), np.ones(3), weight, 0.3, move)
        got = model.marginals(features, many)
        score = features @ weight + 0.3
        assert np.allclose(got, np.concatenate((brute.marginals(score[:n], move), brute.marginals(score[n:], move))))


def test_field_gradient():
    """The gradient against differences, the likelihood against all labellings."""
    rng = np.random.default_rng(7)
    many = np.array([1, 4, 3])
    x, y, theta = rng.normal(size=(8, 3)), rng.integers(0, 2, 8).astype(float), rng.normal(size=8)
    value, slope = line_crf.likelihood(theta, x, y, many)
    for i in range(8):
        step = np.eye(8)[i] * 1e-5
        assert abs((line_crf.likelihood(theta + step, x, y, many)[0] - line_crf.likelihood(theta - step, x, y, many)[0]) / 2e-5 - slope[i]) < 1e-5
    score, move, want, at = x @ theta[:3] + theta[3], theta[4:].reshape(2, 2), -theta @ theta / 2, 0
    for n in many:
        weight = lambda labels: sum(s * l for s, l in zip(score[at : at + n], labels, strict=True)) + sum(move[int(a), int(b)] for a, b in zip(labels, labels[1:], strict=False))  # noqa: B023, E731, E741
        want += weight(y[at : at + n]) - np.log(sum(np.exp(weight(z)) for z in itertools.product((0, 1), repeat=int(n))))
        at += n
    assert abs(value - want) < 1e-9


def test_line_labels():
    """Lines that speak against their document clearly get the other label, but never as much as half of it."""
    many, size = np.array([4, 3, 1]), np.array([50, 20, 10, 40, 9, 50, 9, 30])
    odds = np.array([3.0, -2, -0.5, 1, 4, 2, -3, 5])
    assert line_crf.line_labels(odds, np.array([1, 0, 0]), size, many).tolist() == [1, 0, 1, 1, 1, 0, 0, 0]


def test_mixed_documents(spark):
    """Lines of junk in a good text are told from its others, and the other way round."""
    sf = "/root/testdata/sf0.01"
    texts = spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("length(text) < 20000").orderBy("doc_id").select("text", "quality").collect()
    model = line_crf.train([r.text for r in texts], np.array([r.quality for r in texts]))
    good = [r.text.split("\n")[0] for r in texts if r.quality == 1 and len(r.text.split("\n")[0]) > 80][:20]
    bad = [r.text.split("\n")[-1] for r in texts if r.quality == 0 and len(r.text.split("\n")[-1]) > 80][:20]
    right = 0
    for g, b in zip(good, bad, strict=False):
        features, _, many = line_crf.line_features(["\n".join([g, g[::-1], b, b[::-1]])])
        right += int(np.sum((model.marginals(features, many) > 0.5) == [True, True, False, False]))
    assert right >= 0.9 * 4 * min(len(good), len(bad))


def test_quality(spark, docs, empty):
    frame, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = line_crf.score_documents(frame, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(out) > 50 and sum(r.predicted == r.quality for r in out) / len(out) > 0.95
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and (r.score >= 0.7) == (r.predicted == 1) for r in out)
    flipped = labels.withColumn("quality", F.when(F.expr("crc32(cast(cast(doc_id as string) as binary)) % 4 = 2"), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in line_crf.score_documents(frame, flipped).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-12 for r in out)
    odd = line_crf.score_documents(docs, labels)
    assert odd.count() == docs.count() and odd.where("score is null or score < 0 or score > 1").count() == 0
    assert line_crf.score_documents(empty, labels.where("false")).count() == 0
    assert line_crf.keep_good(docs, labels.where("false")).columns == docs.columns


def test_token_tree(docs, empty):
    count = token_tree.counter(tokenizer("byte_bpe_50k.tiktoken"))
    rng, letters = random.Random(2), "ab c  d\n\t'sé1,.  世"
    for _ in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 200)))
        tree = token_tree.TokenTree(text, count, 8)
        for _ in range(6):
            a = rng.randint(0, len(text))
            b, new = rng.randint(a, min(len(text), a + rng.choice([0, 3, 30]))), "".join(rng.choice(letters) for _ in range(rng.randint(0, 10)))
            tree.edit(a, b, new)
            text = text[:a] + new + text[b:]
            assert (tree.text(), tree.length, tree.total) == (text, len(text), count(text))
    tree, words = token_tree.TokenTree("some words of a text " * 200, count, 64), "and more of it "
    for i in range(300):
        tree.edit(37 * i, 37 * i + 5, words * (1 + i % 3))
    assert max(map(len, tree.parts)) < 3 * 64 and tree.total == count(tree.text()) and tree.encoded < 300 * 6 * 64
    assert max(map(len, token_tree.segments("ab12" * 500, 64))) < 70
    edits = token_tree.derived_edits(3)
    made = docs.select("doc_id", "text", edits.alias("e")).collect()
    got = by_id(token_tree.count_tokens(docs, edits, tokenizer("byte_bpe_50k.tiktoken")))
    for r in made:
        if r.doc_id is None or r.doc_id == 9:
            continue
        text = r.text or ""
        before = count(text)
        for e in r.e:
            a = max(0, min(e.start or 0, len(text)))
            text = text[:a] + (e.new or "") + text[max(a, min(e.stop or 0, len(text))) :]
        assert (got[r.doc_id].n_tokens, got[r.doc_id].n_tokens_after, got[r.doc_id].n_chars_after) == (before, count(text), len(text))
    assert token_tree.count_tokens(empty, edits, tokenizer("byte_bpe_50k.tiktoken")).count() == 0


def test_covering_masks():
    masks = simhash.covering_masks(2)
    assert len(masks) == 7
    assert all(any(not m >> a & 1 and not m >> b & 1 for m in masks) for a in range(64) for b in range(a))
    for m in masks:
        free = [i for i in range(64) if not m >> i & 1]
        further = simhash.covering_masks(2, m)
        assert all(x & m == m != x for x in further) and all(any(not x >> a & 1 and not x >> b & 1 for x in further) for a in free for b in free)


def test_simhash(docs, empty, rows):
    got = simhash.simhash_groups(docs).collect()
    assert len(got) == len(rows)
    prints = sorted({(i, brute.fingerprint(t)) for i, t in rows if i is not None})
    first = brute.groups([p for _, p in prints], lambda a, b: (a ^ b).bit_count() <= 2)
    want = {i: (f"{p:016x}", prints[g][0]) for (i, p), g in zip(prints, first, strict=True)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got if r.doc_id is not None} == want
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.dropDuplicates(["doc_id"]).collect() if r.doc_id is not None) == sorted({c for _, c in want.values()})
    assert simhash.simhash_groups(empty).count() == 0 and simhash.drop_near_copies(empty).count() == 0


def test_components(spark):
    """A long chain, a star, a ring and random links."""
    from acreframe.llm.components import components

    rng = random.Random(10)
    edges = [(i, i + 1) for i in range(0, 90)] + [(200, k) for k in range(201, 260)] + [(300 + i, 300 + (i + 1) % 7) for i in range(7)] + [(rng.randint(-500, -400), rng.randint(-500, -400)) for _ in range(70)] + [(5, 5)]
    rng.shuffle(edges)
    nodes = sorted({x for e in edges for x in e if e[0] != e[1]})
    linked = {frozenset(e) for e in edges}
    first = brute.groups(nodes, lambda a, b: frozenset((a, b)) in linked)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: nodes[g] for n, g in zip(nodes, first, strict=True)}


@pytest.mark.parametrize("radius, bucket", [(2, 64), (2, 4), (1, 4), (3, 16)])
def test_simhash_links(spark, radius, bucket, monkeypatch):
    """A crowd of fingerprints around a few centres: links are the pairs within the radius."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(4)
    prints = [0, 1, 3, 7, 1 << 63]
    for _ in range(6):
        centre = rng.getrandbits(64)
        prints += [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(40)]
    prints = sorted({simhash._signed(p) for p in prints})
    edges = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), radius).collect()
    mask = (1 << 64) - 1
    near = {(a, b) for a in prints for b in prints if a < b and ((a ^ b) & mask).bit_count() <= radius}
    assert {(min(r.u, r.v), max(r.u, r.v)) for r in edges} == near


def test_cuts():
    rng = random.Random(5)
    for _ in range(200):
        width = rng.choice([8, 16, 33])
        places = [0]
        while len(places) < rng.randint(2, 40):
            places.append(places[-1] + rng.randint(1, width))
        costs = [rng.choice([0, 3, 7]) for _ in places]
        cuts = packing.choose_cuts(places, costs, width)
        assert cuts[0] == 0 and cuts[-1] == places[-1] and set(cuts) <= set(places)
        sizes = [b - a for a, b in zip(cuts, cuts[1:], strict=False)]
        cost = sum((0 if n & (n - 1) == 0 else width - n) + packing.WINDOW_COST for n in sizes) + sum(costs[places.index(c)] for c in cuts[1:])
        assert max(sizes) <= width and cost == brute.best_cost(places, costs, width, packing.WINDOW_COST)


@pytest.mark.parametrize("width", [64, 4096])
def test_packing(docs, empty, rows, width, monkeypatch):
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    pieces = packing.pack_documents(docs, path, width).collect()
    texts = {i: t for i, t in rows if i is not None}
    for i, t in texts.items():
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 2]
        own = sorted(((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces if p.doc_id == i), key=lambda p: p[0])
        own = own[:: 2 if i == 9 else 1]
        assert sum(p[1] for p in own) == len(ids) and all(p[3] == len(ids) for p in own)
        for start, n, crc, _ in own:
            assert crc == zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())
    sequences: dict[int, list] = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in sequences.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= width
    assert packing.pack_documents(empty, path, width).count() == 0


def test_padding(spark):
    """Sequences but the last of a partition hardly need padding."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").coalesce(1)
    sizes = [r.n for r in packing.pack_documents(docs, tokenizer("word_bpe_49k.json")).groupBy("sequence_id").agg(F.sum("length").alias("n")).orderBy("sequence_id").collect()]
    assert max(sizes) <= 4096 and sum(4096 - n for n in sizes[:-1] if n & (n - 1)) < 0.01 * sum(sizes)


def test_tokenizer_words():
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    whole, words = Tokenizer.from_file(path), packing.WordTokenizer.of(path)
    rng = random.Random(6)
    for _ in range(2000):
        text = "".join(rng.choice("aAbZ don't've  \n\t.,!?½²3é́ÀİΣσßﬁ世<|endoftext|>_×÷­ ") for _ in range(rng.randint(0, 30)))
        assert words.encode(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)
    for text in ("Ab9." * 5000, "x" * 30000, "é'" * 2000 + " b", "世" * 3000):
        assert words.encode(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("length, crowded, batch", [(100, 1000, 1 << 20), (40, 1000, 700), (40, 1, 700)])
def test_repeats(spark, empty, rows, length, crowded, batch, monkeypatch):
    """With one level and with many, and with anchors' windows beside each other and spread."""
    monkeypatch.setattr(suffix_index, "CROWDED", crowded)
    monkeypatch.setattr(suffix_index, "SINGLE", 400 if crowded == 1 else 100_000)
    monkeypatch.setattr(suffix_index, "TASK_ENTRIES", 60)
    monkeypatch.setattr(suffix_index, "BATCH_BYTES", batch)
    known = [r for r in rows if r[0] is not None]
    base = known[7][1]
    known += [(9, base[50:400] + " and more"), (9, "entirely " * 3 + base[20:300]), (9, known[5][1][:900])]
    frame = spark.createDataFrame([*known, known[3]], "doc_id long, text string").repartition(4)
    want = brute.removed_bytes(known, length)
    got = suffix_index.remove_repeats(frame, length).collect()
    assert len(got) == len(known) + 1 and sum(w[1] for w in want.values()) > 500
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted((i, *want[i, t]) for i, t in [*known, known[3]])
    assert suffix_index.remove_repeats(empty, length).count() == 0


def test_windows_leave_a_task_once(spark, monkeypatch):
    """Windows of a passage that a third of all texts hold, under a crowded anchor: a task names the first of each string, however many slices it reads."""
    import zstandard

    rng = random.Random(15)
    word = lambda n: bytes(rng.choice(b"abcdefgh ") for _ in range(n))
    passage = word(160)
    texts = [(i, 7 * i, word(rng.randint(0, 30)) + passage + word(20)) for i in rng.sample(range(500), 300)]
    pack = zstandard.ZstdCompressor().compress
    runs = [[{"h": 1, "pos": raw.index(passage), "n": 61, "crowded": True}] for *_, raw in texts]
    batch = pa.RecordBatch.from_pydict({"key": [t[0] for t in texts], "row": [t[1] for t in texts], "raw": [pack(t[2]) for t in texts], "runs": runs})
    out = pa.Table.from_batches(list(suffix_index._cut_out(100)(iter([batch.slice(i, 10) for i in range(0, 300, 10)]))))
    firsts = out.filter(pa.compute.equal(out["n"], 0))
    least = min(t[0] for t in texts)
    assert firsts.num_rows == 61 and set(firsts["doc"].to_pylist()) == {least}
    told = {(d, p + k) for d, p, n in zip(out["doc"].to_pylist(), out["pos"].to_pylist(), out["n"].to_pylist(), strict=True) if n < 0 for k in range(-n)}
    assert told == {(i, raw.index(passage) + k) for i, _, raw in texts if i != least for k in range(61)}


def test_repeats_keep_rows_of_one_id(spark):
    """Rows that share an id but nothing else lose nothing."""
    rng = random.Random(14)
    a, b = ("".join(rng.choice("abcdefgh ") for _ in range(300)) for _ in range(2))
    got = suffix_index.remove_repeats(spark.createDataFrame([(1, a), (2, a), (2, b)], "doc_id long, text string").repartition(2)).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (2, 0), (2, 300)]


def test_suffix_levels():
    """Levels are in the order of their bytes, hold each segment once under its first place, and their sizes fall."""
    rng = np.random.default_rng(5)
    pieces, first = rng.choice(np.frombuffer(b"ab", np.uint8), (12, 35)), {}
    monkey, suffix_index.GRAM = suffix_index.GRAM, 6
    try:
        family = suffix_index.Levels(20)
        for doc in rng.permutation(40):
            raw = pieces[rng.integers(0, 12, 9)].ravel()
            h, seg, at, begin, many = suffix_index._segments(raw, np.array([0, len(raw)]), 20)
            entries = np.zeros(len(h), suffix_index.ENTRY)
            entries["h"], entries["seg"], entries["n"], entries["at"], entries["pos"], entries["doc"] = h, seg, many, at, begin, doc
            entries["left"], entries["right"] = at - begin, begin + many + 19 - at
            for x, y in zip(begin, begin + many + 19, strict=True):
                key = raw[x:y].tobytes()
                first[key] = min(first.get(key, (99, 0)), (int(doc), int(x)))
            family.add(raw, entries)
            sizes = [len(x.entries) for x in family.levels]
            assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:], strict=False))
        got = {}
        for level in family.levels:
            text = level.text.tobytes()
            keys = [(text[e["at"] : e["at"] + e["right"]], e["left"], text[e["at"] - e["left"] : e["at"]]) for e in level.entries]
            assert all(a[0] <= b[0] for a, b in zip(keys, keys[1:], strict=False)) and len(set(keys)) == len(keys)
            got |= {left + right: (int(e["doc"]), int(e["pos"])) for e, (right, _, left) in zip(level.entries, keys, strict=True)}
        assert got == first and sum(map(len, family.repeats)) > 50
    finally:
        suffix_index.GRAM = monkey


def test_repeats_without_ids(docs, rows):
    assert suffix_index.remove_repeats(docs, 100, with_bytes=True).count() == len(rows)


def test_repeats_in_long_text(spark, monkeypatch):
    """A document of several batches, in itself and in another one."""
    monkeypatch.setattr(suffix_index, "BATCH_BYTES", 3000)
    rng = random.Random(7)
    a = "".join(rng.choice("abcd ") for _ in range(9000))
    rows = [(2, a + a[1000:5000]), (1, a[2500:3500]), (3, "ab" * 4000)]
    got = suffix_index.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 100).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == {i: v for (i, _), v in brute.removed_bytes(rows, 100).items()}


def test_fm_index():
    rng = np.random.default_rng(1)
    for _ in range(60):
        runs = [rng.integers(1, rng.integers(2, 6), rng.integers(1, 20)).tolist() for _ in range(rng.integers(1, 8))] * int(rng.integers(1, 3))
        seq = np.array([x for r in runs for x in [*r, 0]], np.int32)
        index = fm_index.FMIndex(seq, 4)
        for n in (1, 2, 5):
            phrases = np.array([rng.integers(1, 6, n).tolist() for _ in range(10)], np.int32)
            for p, lo, hi in zip(phrases, *index.search(phrases), strict=True):
                assert sorted(index.locate(np.arange(lo, hi)).tolist()) == [i for i in range(len(seq)) if seq[i : i + n].tolist() == p.tolist()]


@pytest.mark.parametrize("block, held", [(4 << 20, 16 << 20), (60, 120)])
def test_contamination(spark, docs, empty, rows, block, held, monkeypatch):
    """In one pass of one block, and in several passes of several."""
    monkeypatch.setattr(de, "BLOCK_BYTES", block)
    monkeypatch.setattr(de, "PASS_BYTES", held)
    items = {"7": PHRASE, "12": "wise Owls", "30": "unknown words here", "8": PHRASE[4:]}
    bench = spark.createDataFrame([*[(int(k), v) for k, v in items.items()], (40, None), (41, ""), (None, "public report on")], "item_id long, text string")
    got = by_id(de.contamination(docs, bench))
    for i, t in rows:
        if i is not None:
            hit, _ = brute.hit_words(t, items | {"none": "public report on"})
            _, names = brute.hit_words(t, items)
            r = got[i]
            assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(hit), sum(hit), len(names), any(hit))
            assert r.items_sha256 == hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    clean = de.decontaminate(docs, bench)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    assert de.contamination(clean, bench).agg(F.sum("n_hit")).first()[0] == 0
    assert clean.where("text is not null and n_chars != length(text)").count() == 0
    assert de.contamination(empty, bench).count() == 0 and de.contamination(docs, bench.where("false")).where("contaminated").count() == 0


def test_leading_fields_are_searched_once(monkeypatch):
    """Where a line's leading tokens hold no field, none of them is looked at alone; leaves are those of tokens masked one by one."""
    from acreframe.llm import templates as tp

    masked, calls = tp._masked, []
    monkeypatch.setattr(tp, "_masked", lambda t: calls.append(t) or masked(t))
    for line in ("a b c d", "a", "a: //b c", "a 4 c 5", "x://y a@b", "é世 :// b"):
        tokens = line.encode().split()
        want = tp.xxhash.xxh64_intdigest(b"%d " % len(tokens) + b" ".join(map(masked, tokens[: tp.DEPTH])), 42) - (1 << 63)
        assert tp._leaf(tokens) == want
    assert calls == b"a 4 c x://y a@b \xc3\xa9\xe4\xb8\x96 :// b".split()


def test_lines_without_fields_are_searched_once(monkeypatch):
    """A line is masked as its tokens are, and one without a field isn't looked at token by token."""
    from acreframe.llm import templates

    for line in (b"", b"a b", b"a 1 b@c http://x :/ /", b"no: // field", b"  x\t9\x0b\xc2\xa0y"):
        assert templates._masked_line(line, line.split()) == b" ".join(map(templates._masked, line.split()))
    monkeypatch.setattr(templates, "_masked", None)
    assert templates._masked_line(b"words  of prose", [b"words", b"of", b"prose"]) == b"words of prose"
