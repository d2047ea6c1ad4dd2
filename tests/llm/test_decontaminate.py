"""Tiling against a cubic one in plain Python; leaks planted whole, reordered and with edits."""

import random
import time

import numpy as np
import pytest

from posefold.llm.decontaminate import Index, Rolling, contaminated, greedy_tiles, tokens


def brute(a, b, least):
    """Greedy string tiling by the definition: always mark a longest match of unmarked tokens."""
    ma, mb, tiles = [False] * len(a), [x < 0 for x in b], []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not ma[i + n] and not mb[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return tiles
        for k in range(n):
            ma[i + k] = mb[j + k] = True
        tiles.append((i, j, n))


def test_rolling_hash_is_the_window_alone():
    values = np.array([3, 1, 4, 1, 5, 3, 1, 4])
    assert Rolling(values).windows(3)[0] == Rolling(values).windows(3)[5] == Rolling(values[5:]).windows(3)[0]


@pytest.mark.parametrize("most", [0, 100_000])
@pytest.mark.parametrize("seed", range(60))
def test_tiles_are_those_of_the_definition(seed, most, monkeypatch):
    monkeypatch.setattr("posefold.llm.decontaminate.MOST_MATCHES", most)
    random.seed(seed)
    a = [random.randrange(4 + seed % 5) for _ in range(random.randrange(1, 40))]
    b = [random.choice([-1, *range(4 + seed % 5)]) for _ in range(30)] + random.sample(a, len(a)) + a[len(a) // 2 :] + a[: len(a) // 2]
    least = 1 + seed % 4
    got = greedy_tiles(np.array(a), np.array(b), least, first=2 + seed % 7)
    for i, j, n in got:
        assert a[i : i + n] == b[j : j + n] and n >= least
    assert len({i + k for i, _, n in got for k in range(n)}) == sum(n for *_, n in got) == len({j + k for _, j, n in got for k in range(n)})
    assert got == brute(a, b, least)
    assert not leftover(a, b, got, least)


@pytest.mark.parametrize("most", [0, 100_000])
@pytest.mark.parametrize("words", [1, 2, 3])
def test_repeated_words_are_tiled_as_the_definition_says(words, most, monkeypatch):
    monkeypatch.setattr("posefold.llm.decontaminate.MOST_MATCHES", most)
    rng = random.Random(words)
    a, b = ([rng.randrange(words) for _ in range(n)] for n in (12, 90))
    assert greedy_tiles(np.array(a), np.array(b), 4) == brute(a, b, 4)


@pytest.mark.parametrize("words", ["x", "xy"])
def test_a_long_text_of_few_words(words):
    rng = random.Random(5)
    item = " ".join(rng.choice(words) for _ in range(100))
    text = " ".join(rng.choice(words) for _ in range(200_000))
    begun = time.monotonic()
    ((found, size, covered, _, tiles),) = Index([(1, item)], 4).matches(text, 0.6)
    assert (found, size) == (1, 100) and covered >= 96 and time.monotonic() - begun < 30
    for i, j, n in tiles:
        assert item.split()[i : i + n] == text.split()[j : j + n]


def leftover(a, b, tiles, least):
    """Matches of unmarked tokens that greedy tiling should still have marked."""
    ma = {i + k for i, _, n in tiles for k in range(n)}
    mb = {j + k for _, j, n in tiles for k in range(n)}
    return [
        (i, j)
        for i in range(len(a) - least + 1)
        for j in range(len(b) - least + 1)
        if all(a[i + k] == b[j + k] >= 0 and i + k not in ma and j + k not in mb for k in range(least))
    ]


ITEM = "What is the largest moon of the planet Saturn, and who first saw it through a telescope in 1655?"


def test_leaks(spark):
    words, rng = ITEM.split(), random.Random(1)
    noise = lambda n: " ".join(f"n{rng.randrange(999)}" for _ in range(n))
    edited = " ".join(w if i not in (6, 13) else "X" for i, w in enumerate(words))
    reordered = " ".join(words[12:] + ["and"] + words[:12])
    rows = [
        (1, noise(50) + " " + ITEM + " " + noise(50)), (2, noise(300) + reordered), (3, noise(9) + " " + edited.upper()),
        (4, noise(200)), (5, None), (6, ""), (7, " ".join(words[:6]) + noise(9)), (None, ITEM), (8, ITEM), (8, ITEM), (9, noise(40_000) + " " + ITEM),
        (10, "Short one?"), (11, "of the planet " * 500),
    ]
    documents = spark.createDataFrame([(d, t, 0, "x") for d, t in rows], "doc_id long, text string, item_id int, coverage string")
    items = [(70, ITEM), (71, None), (72, "..."), (73, "short one"), (74, noise(30))]
    benchmark = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id int")
    for block in (10, 8_000_000):
        got = contaminated(documents, benchmark, block_bytes=block).collect()
        pairs = sorted((str(r.doc_id), r.item_id) for r in got)
        assert pairs == sorted([("1", 70), ("2", 70), ("3", 70), ("None", 70), ("8", 70), ("8", 70), ("9", 70), ("10", 73)])
        for r in got:
            assert r.coverage == r.covered_tokens / r.item_tokens and sum(t.length for t in r.tiles) == r.covered_tokens
    assert contaminated(documents.limit(0), benchmark).count() == 0
    assert contaminated(documents, benchmark.limit(0)).count() == 0


def test_whole_table_against_brute_force(spark):
    from posefold.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = [(r.item_id, tokens(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = set()
    for d in documents:
        words = tokens(d.text or "")
        seeds = {tuple(words[i : i + 4]) for i in range(len(words) - 3)}
        for item, own in items:
            places = [i for i in range(len(own) - 3) if tuple(own[i : i + 4]) in seeds]
            if len({i + k for i in places for k in range(4)}) >= 0.6 * len(own):
                number = {w: i for i, w in enumerate(dict.fromkeys(own))}
                tiles = brute([number[w] for w in own], [number.get(w, -1) for w in words], 4)
                if sum(n for *_, n in tiles) >= 0.6 * len(own):
                    want.add((d.doc_id, item))
    got = QUERIES["op1_decontamination"](spark, sf).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want) > 0


def test_index_of_nothing():
    assert list(Index([], 4).matches("a b c d e", 0.5)) == []
