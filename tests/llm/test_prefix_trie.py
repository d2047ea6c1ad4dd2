"""The prefix trie against a plain Python trie: whole tables, shards of any size, odd rows."""

import hashlib
import math
import zlib

import pytest

from posefold.llm.prefix_trie import NONE, SearchTree, medians, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, parent_conv_id string"


def brute(rows):
    convs = {}
    for r in rows:
        if r.conv_id is not None:
            convs.setdefault(r.conv_id, []).append(r)

    def name(r):
        role = (r.role or "").encode()
        return hashlib.sha256(b"%d:" % len(role) + role + (r.text or "").encode()).hexdigest()[:32]

    convs = {
        c: [(r.role or "", r.text or "") for r in sorted(own, key=lambda r: (r.turn is not None, r.turn or 0, name(r)))] for c, own in convs.items()
    }
    members, ends = {}, {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole = tuple(convs.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:])
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append(c)
        ends.setdefault(whole, []).append(c)
    out = {}
    for key in sorted(members, key=len, reverse=True):
        kids = [out[k] for k in out if k[:-1] == key and len(k) == len(key) + 1]
        own = (len(members[key]) - 1) * (len(key[-1][1].encode()) if key else 0)
        out[key] = (
            min(members[key]), len(key), min(members[key[:-1]]) if key else None, len(members[key]), len(kids),
            sum(k[5] for k in kids) or 1, own + sum(k[6] for k in kids),
            hashlib.sha256(",".join(map(str, sorted(ends.get(key, [])))).encode()).hexdigest(),
        )
    return sorted(map(str, out.values()))


def rows_of(frame):
    return sorted(str(tuple(r)) for r in frame.collect())


def test_search_tree():
    assert sorted(medians(7)) == list(range(7)) and next(medians(7)) == 3
    tree, words = SearchTree(), [[1, 2], [1, 2, 3], [1, 4], [2], [5, 1]]
    ends = [tree.insert(words[i]) for i in medians(5)]
    assert len(set(ends)) == 5 and len(tree.code) == 1 + 7
    assert [tree.insert(words[i]) for i in medians(5)] == ends and len(tree.code) == 8
    assert all(tree.parent[n] < n for n in range(1, 8))


@pytest.mark.parametrize("n,shard_rows,fan", [(400, 50_000, 64), (400, 3, 2), (60, 1, 2)])
def test_small_tables(spark, n, shard_rows, fan):
    """A hot conversation, shared heads, conversations that end inside others, nulls, repeats."""
    rows = []
    for c in range(n):
        length = 6 if c % 3 == 0 else c % 8
        for turn in range(length):
            text = f"t{turn}" if c % 3 == 0 or turn < 2 else f"é{c % 11}-{turn}"
            rows.append((c, turn, "user" if turn % 2 == 0 else None, text if turn % 5 else None, 1, "x"))
    rows += [(-7, 1, "user", "a", 0, ""), (-5, 0, "user", "b", 0, ""), (None, 0, "user", "lost", 0, ""), (1000, None, None, None, 0, "")]
    rows += [(1001, 2, "user", "same", 0, ""), (1001, 2, "user", "same", 0, ""), (1001, 2, "user", "other", 0, ""), (1002, 0, "user", "z" * 100_000, 0, "")]
    frame = spark.createDataFrame(rows, SCHEMA)
    want = brute(frame.collect())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert rows_of(prefix_trie(frame, shard_rows=shard_rows, fan=fan)) == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_equal_conversations_over_many_shards(spark):
    frame = spark.createDataFrame([(c * 5, t, "user", f"turn {t}") for c in range(200) for t in range(4)], "conv_id long, turn long, role string, text string")
    got = sorted(prefix_trie(frame, shard_rows=7, fan=3).collect(), key=lambda r: r.depth)
    assert [(r.depth, r.n_convs, r.n_children, r.n_leaves) for r in got] == [(0, 200, 1, 1), (1, 200, 1, 1), (2, 200, 1, 1), (3, 200, 1, 1), (4, 200, 0, 1)]
    assert got[0].saved_tokens == 199 * 4 * len("turn 0")
    ids = ",".join(str(c * 5) for c in range(200))
    assert got[4].ends_sha256 == hashlib.sha256(ids.encode()).hexdigest() and got[0].ends_sha256 == NONE


def test_empty(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert prefix_trie(frame).count() == 0
    assert prefix_trie(spark.createDataFrame([(None, 1, "user", "a", 1, "")], SCHEMA)).count() == 0


def test_large_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert rows_of(prefix_trie(frame, shard_rows=20, fan=2)) == brute(frame.collect())
