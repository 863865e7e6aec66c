"""Learned scores, WARC archives, and the pipeline."""

import base64
import hashlib
import zlib

import numpy as np
import pytest

import corpus_pipeline
from settlekit.llm import blobs, doc_stats, quality_trees, toxic_pu, warc_zstd
from settlekit.llm.folds import read
from tests.conftest import SF_SMALL
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def held(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 0


# -- op 8 and op 6 -----------------------------------------------------------


@pytest.mark.parametrize("module,label,least", [(quality_trees, "quality", 0.95), (toxic_pu, "toxic", 0.9)])
def test_held_out_accuracy(spark, module, label, least):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    got = {r.doc_id: r for r in module.score_documents(docs, module.train(docs, labels)).collect()}
    assert len(got) == docs.count() and all(r.held_out == held(d) and 0 <= r.score <= 1 for d, r in got.items())
    rows = [(got[r.doc_id].predicted, r[label]) for r in labels.collect() if held(r.doc_id)]
    assert np.mean([p == y for p, y in rows]) >= least


@pytest.mark.parametrize("module", [quality_trees, toxic_pu])
def test_scores_ignore_everything_but_the_text(spark, module):
    docs, labels = read(spark, SF_SMALL, "documents"), read(spark, SF_SMALL, "labels")
    model = module.train(docs, labels)
    a = {r.doc_id: r.score for r in module.score_documents(docs, model).collect()}
    moved = docs.selectExpr("doc_id + 1000 as doc_id", "text", "'xx' as lang", "'yy' as source")
    assert a == {r.doc_id - 1000: r.score for r in module.score_documents(moved, model).collect()}
    # held-out labels change nothing
    flipped = labels.selectExpr("doc_id", *[f"if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - {c}, {c}) as {c}"
                                            for c in ("quality", "toxic")])
    b = {r.doc_id: r.score for r in module.score_documents(docs, module.train(docs, flipped)).collect()}
    assert a == b


@pytest.mark.parametrize("module", [quality_trees, toxic_pu])
def test_awkward_rows_are_scored(spark, module):
    labels = read(spark, SF_SMALL, "labels")
    model = module.train(read(spark, SF_SMALL, "documents"), labels)
    table = brute.table(spark, repeated=True)
    got = module.score_documents(table, model).collect()
    assert len(got) == table.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out for r in got if r.doc_id is None)
    assert module.score_documents(brute.table(spark, []), model).count() == 0
    for few in (labels.limit(0), labels.filter("quality = 1 and toxic = 0")):
        alone = module.train(brute.table(spark), few)
        assert all(0 <= r.score <= 1 for r in module.score_documents(table, alone).collect())


def test_forest_traversal_matches_a_plain_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    f = quality_trees.fit(x, y, trees=20, depth=3, min_rows=5)
    plain = []
    for row in x:
        s = f.base
        for t in range(len(f.leaf)):
            k = 0
            while k < f.feature.shape[1]:
                k = 2 * k + 2 if row[f.feature[t, k]] > f.cut[t, k] else 2 * k + 1
            s += f.leaf[t, k - f.feature.shape[1]]
        plain.append(1 / (1 + np.exp(-s)))
    assert np.allclose(f.score(x), plain) and ((f.score(x) > 0.5) == y).mean() > 0.95


def test_statistics_do_not_depend_on_the_slice():
    texts = [(t or "").encode() for _, t in brute.texts()]
    whole = doc_stats.matrix(texts)
    assert np.array_equal(whole, np.concatenate([doc_stats.matrix([t]) for t in texts]))
    assert not doc_stats.matrix([b""]).any()


def test_non_negative_risk_keeps_to_the_marking_words():
    rng = np.random.default_rng(4)
    vocabulary = rng.integers(1, 2**63, 2000, dtype=np.uint64)
    mark = vocabulary[:3]
    draw = lambda: np.unique(rng.choice(vocabulary[3:], 80))
    bad = lambda: np.unique(np.append(draw(), rng.choice(mark, 2)))
    positive = [bad() for _ in range(150)]
    unlabelled = [bad() if rng.random() < 0.15 else draw() for _ in range(1500)]
    model = toxic_pu.fit(positive, unlabelled, 0.15)
    known = [bad() for _ in range(60)] + [draw() for _ in range(340)]
    model = toxic_pu.calibrate(model, known, np.array([1.0] * 60 + [0.0] * 340))
    raw = lambda h: model.raw(h, np.zeros(len(h), np.int64), 1)[0]
    assert np.mean([raw(bad()) > 0 for _ in range(200)]) > 0.9
    assert np.mean([raw(draw()) < 0 for _ in range(200)]) > 0.95


# -- op 10 -------------------------------------------------------------------


def pages(spark, rows):
    return spark.createDataFrame([(p, u, h, "clash", "clash", "clash") for p, u, h in rows],
                                 "page_id long, url string, html string, payload string, sha1 string, refers_to string")


def test_warc_round_trip(spark):
    page = "<html>" + "tale " * 400 + "</html>"
    rows = [(1, "http://a/1", page), (2, "http://a/2", page), (3, None, "x"), (4, "http://a/\r\n4", None), (5, "u", ""),
            (6, "ü", "é\r\n\r\nWARC/1.1\r\n"), (7, "u", page * 300), (None, "u", "only"), (None, "u", page), (9, "u", "x")]
    rows += [(100 + k, "http://h/", f"{page}{k % 7}") for k in range(60)]
    path = warc_zstd.write(pages(spark, rows))
    got = warc_zstd.read(spark, path).collect()
    assert len(got) == len(rows)
    top = {}
    for p, _, h in rows:
        top[h or ""] = max(top.get(h or "", -1), -1 if p is None else p)
    want = sorted((str(p), len(b := (h or "").encode()), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                   *(("response", "None") if top[h or ""] == (-1 if p is None else p) else ("revisit", str(top[h or ""]))))
                  for p, _, h in rows)
    assert want == sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in got)
    # payloads come back whole, and the least length is kept
    back = [warc_zstd.parse(raw) for f in blobs.read(spark, path).collect() for raw in warc_zstd.frames(bytes(f.content))]
    bodies = {h["WARC-Record-ID"]: b.decode() for h, b in back if h["WARC-Type"] == "response"}
    assert bodies["<urn:page:7>"] == page * 300 and bodies["<urn:page:6>"] == "é\r\n\r\nWARC/1.1\r\n"
    long = warc_zstd.read(spark, warc_zstd.write(pages(spark, rows), least=100)).collect()
    assert {r.record_type for r in long if r.payload_bytes < 100} == {"response"}


def test_archives_are_closed_by_size(spark, monkeypatch):
    monkeypatch.setattr(warc_zstd, "FILE_BYTES", 2000)
    rng = np.random.default_rng(1)
    rows = [(k, f"http://h/{k}", "".join(map(chr, rng.integers(97, 123, 600)))) for k in range(60)]
    path = warc_zstd.write(pages(spark, rows).coalesce(1))
    files = [bytes(f.content) for f in blobs.read(spark, path).collect()]
    assert len(files) >= 8 and max(map(len, files)) < 60_000   # a dictionary and some 2000 bytes
    assert sorted(r.page_id for r in warc_zstd.read(spark, path).collect()) == list(range(60))


def test_warc_empty_and_broken(spark):
    assert warc_zstd.read(spark, warc_zstd.write(pages(spark, []))).count() == 0
    raw = warc_zstd.record(1, "u", b"body", warc_zstd.digest32(b"body"), None, False, "2024-01-01T00:00:00Z")
    assert warc_zstd.parse(raw)[1] == b"body"
    for bad in (raw.replace(b"body", b"bodies"), raw.replace(b"body", b"bode"), raw[:-2], b"HTTP/1.1" + raw,
                *(b"\r\n".join(x for x in raw.split(b"\r\n") if not x.startswith(h.encode())) for h in warc_zstd.REQUIRED)):
        with pytest.raises(ValueError):
            warc_zstd.parse(bad)
    with pytest.raises(ValueError):
        list(warc_zstd.frames(b"\x28\xb5\x2f\xfd" + b"\0" * 20))


# -- pipeline ----------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = read(spark, SF_SMALL, "documents")
    rows = dict(docs.select("doc_id", "text").collect())
    out = {}
    frame = docs
    for name, stage in corpus_pipeline.STAGES:
        frame = corpus_pipeline.stage_table(stage(spark, frame, SF_SMALL), "test")
        out[name] = frame
        if name != "packing":
            assert frame.columns == docs.columns
    forest = quality_trees.train(docs, read(spark, SF_SMALL, "labels"))
    good = {d for d, t in rows.items() if forest.score(doc_stats.matrix([(t or "").encode()]))[0] >= 0.3}
    assert {r.doc_id for r in out["quality classifier"].collect()} == good < set(rows)
    gone = brute.line_dedup([(d, rows[d]) for d in good])
    lines = {d: "\n".join(x for i, x in enumerate(rows[d].split("\n")) if i not in gone[d]) for d in good}
    assert {r.doc_id: (r.text, r.n_chars) for r in out["line dedup"].collect()} == {
        d: (t, len(t)) for d, t in lines.items()}
    near = brute.components(list(lines.items()), 5, 80, 100)
    first = {d for d in good if near[d][1] == d}
    assert {r.doc_id for r in out["n-gram Jaccard join"].collect()} == first
    bench = [r.text for r in read(spark, SF_SMALL, "benchmark").collect()]
    clean = {r.doc_id for r in out["benchmark decontamination"].collect()}
    assert clean <= first and not any(b in lines[d] for d in clean for b in bench)
    leaked = {d for d in first if any(b.lower() in lines[d].lower() for b in bench)}
    assert first - clean == leaked
    pieces = out["packing"].collect()
    assert {r.doc_id for r in pieces} == clean
    assert sum(r.length for r in pieces) == sum(r.doc_tokens for r in pieces if r.start == 0)
    assert corpus_pipeline.run(spark, SF_SMALL).count() == len(pieces)


def test_pipeline_on_awkward_rows(spark):
    frame = brute.table(spark, repeated=True)
    for name, stage in corpus_pipeline.STAGES:
        frame = corpus_pipeline.stage_table(stage(spark, frame, SF_SMALL), "test")
    assert frame.count() > 0
    frame = brute.table(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        frame = corpus_pipeline.stage_table(stage(spark, frame, SF_SMALL), "test")
    assert frame.count() == 0
