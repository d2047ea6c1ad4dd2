"""The quality classifier: features, the fit, held-out accuracy, edge cases."""

import zlib

import numpy as np
import pytest

from posefold.llm.quality import FEATURE_BITS, classify, dual_coordinate_descent, indicators, log_count_ratio, shape, words_of


@pytest.mark.parametrize("word,want", [("The", "Aa"), ("THE!!", "AA!!"), ("a***", "a**"), ("|", "|"), ("x9,", "a9,"), ("aA1b2c3d4e5,f", "aA9a9a9a9a9,a")])
def test_shape(word, want):
    assert shape(word) == want


def test_whole_texts_without_spaces():
    long = "a" * 64 + "!!!"
    assert words_of(f"one {'b' * 64} two") == ["one", "b" * 64, "two"]
    assert words_of(long) == ["aa"] * 63 + ["a!", "!!", "!!"]
    assert set(indicators(long)) != set(indicators("a" * 64)) != set(indicators("a" * 65))
    head = "字" * 5000
    assert set(indicators(head)) < set(indicators(head + "尾"))


def test_blocks_do_not_change_features(monkeypatch):
    text = "One two, three THREE three three!! 44 | | x " * 30
    whole = indicators(text)
    monkeypatch.setattr("posefold.llm.quality.BLOCK_WORDS", 7)
    assert (indicators(text) == whole).all()


def test_fit_separates():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 50, 8)) for _ in range(200)]
    good = np.array([not (row < 5).any() for row in rows])
    counts = [np.bincount(np.concatenate([r for r, g in zip(rows, good) if g is np.bool_(k)]), minlength=50) for k in (1, 0)]
    ratio = log_count_ratio(*map(np.asarray, counts))
    weights, bias = dual_coordinate_descent(rows, np.where(good, 1.0, -1.0), ratio, epochs=40)
    margins = np.array([weights[r].sum() + bias for r in rows])
    assert ((margins > 0) == good).mean() > 0.97


def documents_of(spark, n=400):
    rows = []
    for i in range(n):
        text = f"A plain sentence number {i} about w{i * 7 % 31}, with a full stop." if i % 4 else f"NOISE!! {i} NOISE!! LOUD!! W{i}!! LOUD!!"
        rows.append((i, text, 1, "s"))
    rows += [(None, "plain words", 0, ""), (n, None, 0, ""), (n + 1, "", 0, ""), (2, "A plain sentence again.", 0, "")]
    return spark.createDataFrame(rows, "doc_id long, text string, score int, good string")


def test_small_table(spark):
    documents = documents_of(spark)
    labels = spark.createDataFrame(
        [(i, int(i % 4 != 0), 0) for i in range(400)] + [(3, None, 0), (None, 1, 0), (5, 1, 1), (9999, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    got = classify(documents, labels).collect()
    assert len(got) == 404
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if r.doc_id is not None and r.doc_id < 400 and r.held_out:
            assert r.predicted == int(r.doc_id % 4 != 0)
    assert classify(documents.limit(0), labels).count() == 0


def test_held_out_labels_are_not_used(spark):
    documents = documents_of(spark)
    labels = [(i, int(i % 4 != 0), 0) for i in range(400)]
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    both = [sorted(map(str, classify(documents, spark.createDataFrame(x, schema)).collect())) for x in (labels, turned)]
    assert both[0] == both[1]


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)]])
def test_one_class_or_none(spark, labels):
    got = classify(documents_of(spark, 20), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len({r.score for r in got}) == 1 and len(got) == 24


def test_held_out_accuracy(spark):
    from posefold.llm.queries import QUERIES

    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [(labels[r.doc_id], r.predicted) for r in QUERIES["op8_quality"](spark, sf).collect() if r.held_out and r.doc_id in labels]
    assert len(rows) > 500
    assert sum(a == b for a, b in rows) / len(rows) > 0.97
    assert sum(b for a, b in rows if a) / sum(a for a, _ in rows) > 0.99


def brute(rows, labels, bits):
    """Scores by plain Python: counts over all labelled training rows, then one fit on their indicators."""
    train = [(d, t) for d, t in rows if d in labels and zlib.crc32(str(d).encode()) % 5]
    counts = np.zeros((2, 1 << bits))
    for d, t in train:
        for f in set(indicators(t, bits).tolist()):
            counts[labels[d], f] += 1
    ratio = log_count_ratio(counts[1], counts[0])
    weights, bias = dual_coordinate_descent(
        [indicators(t, bits) for _, t in train], np.array([1.0 if labels[d] else -1.0 for d, _ in train]), ratio, epochs=60
    )
    return {d: weights[indicators(t, bits)].sum() + bias for d, t in rows}


def test_scores_order_documents_as_the_plain_fit_does(spark):
    from posefold.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    margins = brute(rows, labels, FEATURE_BITS)
    got = {r.doc_id: r for r in QUERIES["op8_quality"](spark, sf).collect()}
    assert got.keys() == margins.keys()
    ids = sorted(got)
    a, b = (np.argsort(np.argsort([x[d] for d in ids])) for x in (margins, {d: r.score for d, r in got.items()}))
    assert np.corrcoef(a, b)[0, 1] > 0.98
