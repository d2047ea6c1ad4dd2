"""Counts against the library's own on whole texts."""

import pytest

from posefold.llm.bpe import load, piece_encoder
from posefold.llm.token_counts import count_tokens, cut

NAME = "byte_bpe_50k.json"
ODD = [
    "a  b", "a   b", "\n\n  x y", " a", "", "  ", "a <|endoftext|> b", "x<|endoftext|>y z", "a \n b\t c",
    "é  x   y", "it's  we'll", "\x1c a\x1d b", "a\n  b \n  c", "word ", "x" * 300, "ab " * 200, " \n" * 90 + "q",
    "Ünïcode wörds " * 40, "日本語。テキスト" * 30 + " end", "1234567 89 " * 30, "tab\there  there x y",
]


@pytest.mark.parametrize("text", ODD)
def test_pieces_give_the_ids_of_the_text(text):
    from array import array

    whole = load(NAME).encode(text, add_special_tokens=False).ids
    assert piece_encoder(NAME).encode([text])[0] == array("I", whole).tobytes()


@pytest.mark.parametrize("text", [t * k for t in ODD for k in (1, 5)])
@pytest.mark.parametrize("chunk,overlap", [(10, 2), (64, 8)])
def test_cuts_cover_the_text_and_overlap(text, chunk, overlap):
    cuts = list(cut(text, chunk, overlap))
    assert cuts[0][0] == cuts[0][2] == 0 and cuts[-1][1] == cuts[-1][3] == len(text)
    for (_, end, _, tail), (begin, _, head, _) in zip(cuts, cuts[1:]):
        assert tail == head and begin <= head < end


def test_counts_equal_the_library(spark):
    texts = [t * k for t in ODD for k in (1, 7)] + [None, ODD[0], ODD[0]]
    rows = [(i if i != 3 else None, t, "x", 5) for i, t in enumerate(texts)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, id int")
    got = count_tokens(documents, chunk=40, overlap=4, limit=10).collect()
    library = load(NAME)
    want = sorted(
        (str(d), len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False)), n > 10)
        for d, t, _, _ in rows
    )
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert count_tokens(empty).count() == 0


def test_whole_table_against_the_library(spark):
    from posefold.llm.queries import QUERIES

    got = {r.doc_id: r.n_tokens for r in QUERIES["op10_token_counts"](spark, "/root/testdata/sf0.001").collect()}
    library = load(NAME)
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert got == {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False)) for r in rows}
