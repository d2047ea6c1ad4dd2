"""Exact dedup against grouping in plain Python; the code against itself."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from posefold.llm import rice
from posefold.llm.exact_dedup import dedup_exact


@given(st.sets(st.integers(0, (1 << 40) - 1), min_size=1, max_size=300))
def test_rice_round_trip(values):
    values = np.array(sorted(values))
    low_bits = rice.parameter(1 << 40, len(values))
    assert (rice.decode(*rice.encode(values, low_bits), low_bits, len(values)) == values).all()


def brute(rows):
    def norm(text):
        return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")

    groups = {}
    for doc, text in rows:
        groups.setdefault(norm(text), []).append(doc)
    out = []
    for doc, text in rows:
        ids = groups[norm(text)]
        keep = min((i for i in ids if i is not None), default=None)
        out.append((doc, keep, len(ids), hashlib.sha256(norm(text).encode()).hexdigest()))
    return out


ROWS = [
    (5, "a b"), (3, "a  b"), (9, "a\n\tb"), (4, "a b "), (4, "a b "), (7, None), (2, ""), (None, "solo"), (None, "two"),
    (None, "two"), (11, "a b"), (12, "x" * 50_000), (13, "x" * 50_000), (-6, "a b"), (20, "A b"),
] + [(100 + i, "copy") for i in range(300)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_against_plain_grouping(spark, partitions):
    wide = [(d, t, "s", True, 1) for d, t in ROWS]
    documents = spark.createDataFrame(wide, "doc_id long, text string, body string, kept boolean, fp int")
    got = dedup_exact(documents.repartition(partitions)).collect()
    key = lambda row: tuple(map(str, row))
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=key) == sorted(brute(ROWS), key=key)
    kept = {}
    for r in got:
        kept.setdefault(r.text_sha256, []).append(r.doc_id) if r.kept else None
        assert not r.kept or r.doc_id == r.keep_id
    assert all(len(ids) == 1 for ids in kept.values()) and len(kept) == len({r.text_sha256 for r in got})


def test_empty_table(spark):
    assert dedup_exact(spark.createDataFrame([], "doc_id long, text string")).count() == 0
