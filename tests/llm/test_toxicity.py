"""Toxicity: folding, matching against a plain search, exceptions, held-out accuracy, edge cases."""

import random
import zlib

import numpy as np
import pytest

from posefold.llm.toxicity import Matcher, folded_words, score_toxicity, terms_of, weights_of

LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize(
    "text,want",
    [
        ("Idiot!!", ["idiot"]),
        ("1d10t and l0$er", ["idiot", "and", "loser"]),
        ("іdіоt", ["idiot"]),
        ("ｉｄｉｏｔ", ["idiot"]),
        ("id​iot", ["idiot"]),
        ("covid19 in 2020, 3 x", ["covid", "in", "x"]),
        ("a5!b", ["asib"]),
        ("réel Äpfel", ["réel", "äpfel"]),
        ("", []),
        ("12 -- !!", []),
    ],
)
def test_folding(text, want):
    assert folded_words(text) == want


def test_matcher_against_plain_search():
    rng = random.Random(3)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    weights = {term: rng.random() + 0.1 for term in {t for w in words[:60] for t in terms_of(w)}}
    phrases = [f" {words[i]} {words[i + 1]} " for i in range(0, 100, 9)] + [f" {words[5]} "]
    matcher = Matcher(weights, phrases)
    for begin in range(0, 400, 20):
        run = words[begin : begin + 20]
        want, at = {}, 0
        for i, word in enumerate(run):
            best = max((weights[t] for t in terms_of(word) if t in weights), default=0.0)
            near = {f" {word} "} | {f" {a} {b} " for a, b in zip(run[max(0, i - 1) : i + 1], run[max(0, i - 1) + 1 : i + 2])}
            if best and not near & set(phrases):
                want[at] = (word, best)
            at += len(word) + 1
        assert matcher.hits(run) == want
        assert matcher.total(run) == pytest.approx(sum(dict(want.values()).values()))
    assert Matcher({}, []).hits(["a"]) == {}


def test_stems_of_one_word_are_left_to_it():
    terms = [" idio", " idiot ", " vequ", " vequta ", " vequno ", " the "]
    got = weights_of(terms, np.array([50, 50, 60, 20, 20, 50]), np.array([1, 0, 0, 0, 0, 400]), 1000, 8000)
    assert set(got) == {" idiot ", " vequ", " vequta ", " vequno "}


def documents_of(spark, n=600):
    """Every fourth text insults; every third clean one speaks of a scum line, which is none."""
    rng = random.Random(5)
    rows = []
    for i in range(n):
        words = [f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(rng.randint(20, 60))]
        if i % 4 == 0:
            words[3:3] = ["Scum", "you"]
            words.append("kretin" + rng.choice("aeiou") * 2)
        elif i % 3 == 0:
            words[5:5] = ["scum", "line"]
        rows.append((i, " ".join(words), 1, "s"))
    rows += [(None, "plain words", 0, ""), (n, None, 0, ""), (n + 1, "", 0, ""), (2, "again plain", 0, ""), (n + 2, "ѕсum you " + "word " * 30, 0, "")]
    return spark.createDataFrame(rows, "doc_id long, text string, score int, toxic string")


def test_small_table(spark):
    documents = documents_of(spark)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(600)] + [(3, 0, None), (None, 0, 1), (5, 1, 0), (9999, 1, 0)], LABELS)
    got = score_toxicity(documents, labels).collect()
    assert len(got) == 605
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
            if r.doc_id < 600:
                assert r.predicted == int(r.doc_id % 4 == 0), r
            else:
                assert r.predicted == int(r.doc_id == 602)
    assert score_toxicity(documents.limit(0), labels).count() == 0


def test_held_out_labels_are_not_used(spark):
    documents = documents_of(spark)
    labels = [(i, 1, int(i % 4 == 0)) for i in range(600)]
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    both = [sorted(map(str, score_toxicity(documents, spark.createDataFrame(x, LABELS)).collect())) for x in (labels, turned)]
    assert both[0] == both[1]


@pytest.mark.parametrize("labels", [[], [(1, 1, 1), (2, 1, 1)]])
def test_one_class_or_none(spark, labels):
    got = score_toxicity(documents_of(spark, 20), spark.createDataFrame(labels, LABELS)).collect()
    assert len({r.score for r in got}) == 1 and len(got) == 25


def test_held_out_accuracy(spark):
    from posefold.llm.queries import QUERIES

    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [(labels[r.doc_id], r.predicted) for r in QUERIES["op13_toxicity"](spark, sf).collect() if r.held_out and r.doc_id in labels]
    assert len(rows) > 500
    assert sum(a and b for a, b in rows) / sum(b for _, b in rows) > 0.97
    assert sum(a and b for a, b in rows) / sum(a for a, _ in rows) > 0.9
