"""The code against sorted lists, the files against the library."""

import zlib
from array import array

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from posefold.llm.bpe import load
from posefold.llm.elias_fano import EliasFano
from posefold.llm.token_files import Segment, read_documents, read_segments, token_folder, write_tokens

NAME = "byte_bpe_50k.json"


@given(st.lists(st.integers(0, 5000), max_size=400), st.sampled_from([1, 1000, 1 << 30]))
def test_elias_fano_round_trip(values, scale):
    values = sorted(v * scale for v in values)
    code = EliasFano.of(np.array(values, dtype=np.int64))
    assert code.all().tolist() == values if values else code.n == 0
    assert [code.select(i) for i in range(code.n)] == values


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 20_000))
    code = EliasFano.of(values)
    assert len(code.low) + len(code.high) + len(code.samples) < 20_000 * 1.75


def expected(rows):
    library, start, out = load(NAME), 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc, start, len(ids), zlib.crc32(array("I", ids).tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("segment", [3, 40, 10_000])
def test_files_give_back_the_ids(spark, segment):
    rows = [(9, "b c"), (-1, "first"), (4, None), (5, ""), (7, "x " * 500), (8, "é<|endoftext|>"), (None, "none")]
    wide = [(d, t, 1, "q") for d, t in rows]
    documents = spark.createDataFrame(wide, "doc_id long, text string, part int, ids string").repartition(3)
    path = token_folder(spark)
    write_tokens(documents, path, segment_tokens=segment)
    got = [tuple(r) for r in read_documents(spark, path).collect()]
    key = lambda r: r[1]
    assert sorted(got, key=key) == expected(rows)
    library = load(NAME)
    for row in read_segments(spark, path).collect():
        one = Segment(row.asDict())
        for i, doc in enumerate(one.doc_ids):
            text = dict(rows)[doc] or ""
            assert one.document(i).tolist() == library.encode(text, add_special_tokens=False).ids + [0]


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "a")] * 3 + [(2, "b")]
    path = token_folder(spark)
    write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path)
    assert sorted(map(tuple, read_documents(spark, path).collect()), key=lambda r: r[1]) == expected(rows)
    path = token_folder(spark)
    write_tokens(spark.createDataFrame([], "doc_id long, text string"), path)
    assert read_documents(spark, path).count() == 0


def test_whole_table_against_the_library(spark):
    from posefold.llm.queries import QUERIES

    got = QUERIES["op3_token_files"](spark, "/root/testdata/sf0.001").collect()
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, got)) == expected([tuple(r) for r in rows])
