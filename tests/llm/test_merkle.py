"""The Merkle manifest against plain Python trees of several shapes, and what tampering does."""

import hashlib
import zlib

import pytest

from posefold.llm.merkle import manifest, packed, reduced, siblings, unpacked

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, pos int, leaf string, root string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows, fan):
    def leaf(r, text):
        values = (r.doc_id, r.source, r.lang, r.n_chars, text)
        return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def tree(hashes):
        levels = [hashes]
        while len(levels[-1]) > 1:
            levels.append([digest("".join(levels[-1][i : i + fan])) for i in range(0, len(levels[-1]), fan)])
        return levels

    groups = {}
    for r in rows:
        groups.setdefault(r.source, []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for own in groups.values():
        own.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
    trees = {s: tree([leaf(r, r.text) for r in groups[s]]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    root, out = top[-1][0], []
    for place, source in enumerate(order):
        for i, r in enumerate(groups[source]):
            node = own = trees[source][0][i]
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0:
                node = leaf(r, r.text and "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text))
            proof = ""
            for levels, at in ((trees[source], i), (top, place)):
                for level in levels[:-1]:
                    run, mine = level[at // fan * fan : at // fan * fan + fan], at % fan
                    proof += "".join(run[:mine] + run[mine + 1 :])
                    node = digest("".join(run[:mine] + [node] + run[mine + 1 :]))
                    at //= fan
            out.append((r.doc_id, own, trees[source][-1][0], root, digest(proof), node, node == root))
    return sorted(map(str, out))


def rows_of(frame):
    return sorted(str(tuple(r)) for r in frame.collect())


@pytest.mark.parametrize("n", [1, 15, 16, 17, 256, 257, 300])
def test_superblocks(n):
    hashes = [digest(str(i)) for i in range(n)]
    tiers = reduced(hashes, n, 16, 3)
    assert len(tiers[-1]) == 1 and len(tiers) == (1 if n == 1 else 2 if n <= 16 else 3 if n <= 256 else 4)
    for at in {0, n // 2, n - 1}:
        path = siblings(tiers, at, 16)
        assert unpacked(packed(path)) == path
        node = hashes[at]
        for left, right in path:
            node = digest(left + node + right)
        assert node == tiers[-1][0]
    # The last block of a larger tree is reduced as far as the others, even from one node.
    assert len(reduced(hashes[:1], 16**3 + 1, 16, 3)) == 4


@pytest.mark.parametrize("fan,levels", [(16, 3), (2, 1), (3, 2)])
def test_shapes(spark, fan, levels):
    rows = [(i, "hot", "en", i, f"Text {i} WITH CAPITALS é", 0, "x", "y") for i in range(70)]
    rows += [(100 + i, f"s{i}", None, None, "no capitals", 0, "", "") for i in range(20)]
    rows += [(None, "hot", "en", 1, "A", 0, "", ""), (None, None, None, None, None, 0, "", ""), (5, None, "de", 2, "", 0, "", "")]
    rows += [(3, "hot", "en", 3, "Text 3 WITH CAPITALS é", 0, "x", "y"), (3, "hot", "fr", 3, "other", 0, "", ""), (7, "", "", 0, "L" * 200_000, 0, "", "")]
    rows += [(9_007_199_254_740_993, "big", "en", 1, "Z", 0, "", "")]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(manifest(frame, fan=fan, levels=levels)) == brute(frame.collect(), fan)


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(2, "s", "en", 1, "A", 0, "", "")], SCHEMA)
    assert rows_of(manifest(one)) == brute(one.collect(), 16)
    assert manifest(one.limit(0)).count() == 0


def test_tampering(spark):
    frame = spark.createDataFrame([(i, f"s{i % 3}", "en", 1, "Aa" if i % 2 else "aa", 0, "", "") for i in range(200)], SCHEMA)
    for r in manifest(frame).collect():
        assert r.verified == (not (zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.doc_id % 2))
