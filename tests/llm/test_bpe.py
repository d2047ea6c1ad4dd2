"""Ids by pieces against the library's on whole texts."""

from array import array

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from posefold.llm import bpe
from posefold.llm.bpe import PieceEncoder, load

NAME = "byte_bpe_50k.json"
WORDS = ["a", "the", "word", "word,", "word.", "é.", "x\ny", "end.\nNext", "\n", "\t", "", "\x1c", " ", " z", "it's", "'s", "12",
         "<|endoftext|>", "日本", "w" * 70, "$$$", ",", "."]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(WORDS), max_size=12).map(" ".join), max_size=8), st.sampled_from([3, 1000]))
def test_any_words_in_small_generations_and_runs(texts, generation):
    library = load(NAME)
    encoder = PieceEncoder(library)
    expected = [array("I", library.encode(text, add_special_tokens=False).ids).tobytes() for text in texts]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(bpe, "GENERATION", generation)
        patch.setattr(bpe, "WORDS", 5)
        for _ in range(2):
            encoder._copies.clear()
            assert encoder.encode(texts) == expected
