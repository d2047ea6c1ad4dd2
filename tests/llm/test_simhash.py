"""SimHash against a plain count of bits, the masks against random pairs, classes against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from posefold.llm.simhash import covering_masks, fingerprint, links, near_duplicates, stars


def plain(text, words=4):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    tokens = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


TEXTS = ["", " \n", "one", "One TWO three", "a b c d", "É a B c d e f", "x y " * 50, "the cat sat on the mat " * 9]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert fingerprint(text) == plain(text)


def test_long_text_in_runs(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(1000))
    monkeypatch.setattr("posefold.llm.simhash.HASHES", 64)
    assert fingerprint(text) == plain(text)


@pytest.mark.parametrize("radius", [1, 2, 4, 7])
def test_masks_cover(radius):
    masks = covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    assert min(mask.bit_count() for mask in masks) >= 20  # unlike fingerprints seldom meet
    random.seed(radius)
    for _ in range(3000):
        a = random.getrandbits(64)
        b = a
        for place in random.sample(range(64), radius):
            b ^= 1 << place
        assert any(a & m == b & m for m in masks)


def brute(values, radius=4):
    label = {v: v for v in values}

    def root(v):
        while label[v] != v:
            v = label[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= radius:
                label[max(root(a), root(b))] = min(root(a), root(b))
    return {v: root(v) for v in values}


def family(seed, centres=6, each=25):
    random.seed(seed)
    out = set()
    for _ in range(centres):
        value = random.getrandbits(64)
        for _ in range(each):
            out.add(value)
            for _ in range(random.randint(1, 6)):
                value ^= 1 << random.randrange(64)
    return sorted(out)


@pytest.mark.parametrize("tile", [4, 4096])
def test_links_make_the_classes_of_all_pairs(spark, tile):
    from posefold.llm.common import components

    values = [v - (1 << 64) * (v >> 63) for v in family(3)] + [0, 1, 3, 7]
    found = links(spark.createDataFrame([(v,) for v in values], "fp long"), 4, tile)
    got = {r.node: r.component for r in components(found, "t").collect()}
    unsigned = {v: v % (1 << 64) for v in values}
    want = brute(list(unsigned.values()))
    groups = {}
    for v in values:
        groups.setdefault(want[unsigned[v]], []).append(v)
    for members in groups.values():
        assert {got.get(v, v) for v in members} == {min(members)}


def test_stars_are_few():
    values = np.array(family(5), dtype=np.uint64)
    a, b = stars(values, 4)
    assert len(a) == len(values) - len(set(brute([int(v) for v in values]).values()))


def test_rows(spark):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 30
    rows = [(5, base), (3, base + "omega"), (9, base.upper()), (None, base), (1, None), (8, ""), (2, "  "), (7, "else where"), (7, "else where")]
    documents = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, fp int")
    got = near_duplicates(documents).collect()
    fps = {t: plain(t or "") for _, t in rows}
    roots = brute(sorted(set(fps.values())))
    least = {}
    for d, t in rows:
        if d is not None:
            least[roots[fps[t]]] = min(d, least.get(roots[fps[t]], d))
    want = [(d, f"{fps[t]:016x}", least[roots[fps[t]]]) for d, t in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert near_duplicates(documents.limit(0)).count() == 0


def test_whole_table(spark):
    from posefold.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    fps = {d: plain(t or "") for d, t in rows}
    roots = brute(sorted(set(fps.values())))
    least = {}
    for d, fp in fps.items():
        least[roots[fp]] = min(d, least.get(roots[fp], d))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op9_simhash"](spark, sf).collect()}
    assert got == {d: (f"{fp:016x}", least[roots[fp]]) for d, fp in fps.items()}
