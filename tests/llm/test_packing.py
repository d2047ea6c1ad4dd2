"""Packing against the library's ids, the capacity and plain best fit."""

import random
import zlib
from array import array

import pytest

from posefold.llm.bpe import load
from posefold.llm.packing import OPEN_BINS, Packer, cut_lengths, pack_documents, sequences, token_pieces

NAME = "byte_bpe_50k.json"


@pytest.mark.parametrize("total,want", [(1, [1]), (1024, [1024]), (1025, [1, 1024]), (3000, [952, 1024, 1024])])
def test_cut_lengths(total, want):
    assert cut_lengths(total, 1024) == want


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_packer_is_bounded_best_fit(most):
    random.seed(most)
    packer, free, open_ = Packer(50, most), {}, set()
    for _ in range(2000):
        length = random.randint(1, 49)
        fits = [free[b] for b in open_ if free[b] >= length]
        bin_, offset = packer.place(length)
        if fits:
            assert free[bin_] == min(fits) and offset == 50 - free[bin_]
        else:
            assert bin_ not in free and offset == 0
            free[bin_] = 50
        free[bin_] -= length
        open_.discard(bin_)
        if free[bin_]:
            open_.add(bin_)
        if len(open_) > most:
            least = min(free[b] for b in open_)
            open_ = {b for b in open_ if free[b] > least or packer_holds(packer, b, least)}
        assert len(open_) <= most


def packer_holds(packer, bin_, free):
    return bin_ in packer._free[free]


def check(rows, got, capacity):
    library, by_doc, by_sequence = load(NAME), {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        pieces = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [r.length for r in pieces] == cut_lengths(len(ids), capacity)
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(array("I", ids[r.start : r.start + r.length]).tobytes())
    for spots in by_sequence.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence), sum(r.length for r in got)


def test_small_cases(spark):
    rows = [(1, "a b c"), (2, None), (3, ""), (4, "x y z " * 40), (None, "solo"), (6, "word " * 7)]
    documents = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, offset int")
    packed = pack_documents(documents, capacity=16, with_ids=True)
    check(rows, packed.collect(), 16)
    for row in sequences(packed).collect():
        assert len(row.ids) == 4 * sum(row.lengths)
    assert pack_documents(documents.limit(0)).count() == 0
    again = spark.createDataFrame([(1, "a b c")] * 5, "doc_id long, text string")
    assert pack_documents(again).count() == 5


def test_whole_table(spark):
    from posefold.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op5_packing"](spark, sf).collect()
    used, total = check(rows, got, 1024)
    assert used <= -(-total // 1024) * 1.02
    again = Packer(1024, 65_536)
    [again.place(r.length) for r in sorted(got, key=lambda r: (r.doc_id, r.piece)) if r.length < 1024]
    assert used - sum(r.length == 1024 for r in got) <= again.bins * 1.01  # closing bins costs next to nothing


def test_bins_close_in_the_whole_table(spark):
    sf = "/root/testdata/sf0.1"
    lengths = [r.length for r in token_pieces(spark.read.parquet(f"{sf}/documents.parquet")).orderBy("doc_id", "piece").collect() if r.length < 1024]
    packer = Packer(1024, OPEN_BINS)
    [packer.place(n) for n in lengths]
    assert packer.closed > 100 and packer.bins * 1024 < sum(lengths) * 1.03
