"""Exact byte-level BPE ids by way of space-led pieces, common ones encoded once per worker.

The byte-level pre-tokeniser never puts a non-space character and white space after it into one word,
so a text may be cut before every white space that follows a non-space character, and the ids of the cuts,
one after another, are the ids of the text. The argument looks at no more than those two characters,
hence it holds for any text, and a special token's string (which has no space) is never cut either.
"""

from __future__ import annotations

import os
import re
from array import array
from itertools import chain, filterfalse

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

#: Places between a non-space character and white space: proven cuts.
STABLE = re.compile(r"(?<=\S)(?=[ \t-\r])")
#: Letters are a word of their own, and so is the comma or full stop that ends the piece.
STOPPED = re.compile(r"[A-Za-zÀ-ÖØ-öø-ɏ]+[,.]")
#: Words kept by a worker: two generations of at most so many. A worker's memory is bounded by it.
GENERATION = 500_000
#: Words that are split and looked up together.
WORDS = 100_000
#: Texts of at most so many characters are remembered, so many at most: copies often come in numbers.
COPY_CHARS, COPIES = 8_192, 4_096
#: Words encoded in one call; longer texts gain nothing from the library.
GROUP = 100
_LOADED: dict[str, "PieceEncoder"] = {}


def load(name: str) -> Tokenizer:
    """The tokenizer of a vocabulary name, or of a path to one."""
    return Tokenizer.from_file(name if os.sep in name else public_tokenizers.path(name))


def piece_encoder(name: str) -> "PieceEncoder":
    """One encoder per Python worker and vocabulary."""
    if name not in _LOADED:
        _LOADED[name] = PieceEncoder(load(name))
    return _LOADED[name]


def is_byte_level(tokenizer: Tokenizer) -> bool:
    """Whether cuts before spaces are proven: bytes are kept as they are and split by the usual rule."""
    return tokenizer.normalizer is None and "ByteLevel(add_prefix_space=False" in str(tokenizer.pre_tokenizer)


class PieceEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, tokenizer: Tokenizer):
        if not is_byte_level(tokenizer):
            raise ValueError("pieces are proven for byte-level vocabularies without a normaliser only")
        self.tokenizer = tokenizer
        added = {token.content for token in tokenizer.get_added_tokens_decoder().values()}
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        #: Bytes of each id; a byte-level token has one character for each of its bytes.
        self._bytes_of = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        for token, number in vocabulary.items():
            self._bytes_of[number] = len(token.encode()) if token in added else len(token)
        self._stops = dict(zip(",.", self._ids([",", "."])))
        self._copies: dict[str, bytes] = {}
        self._young: dict[str, bytes | None] = {}
        self._old: dict[str, bytes | None] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", one.ids).tobytes() for one in found]

    def _pieces(self, words: list[str]) -> list[bytes]:
        """Ids of every word with a space before it. Words are encoded side by side where the cuts
        between them are proven, and told apart by the bytes that the ids stand for."""
        out = []
        for at in range(0, len(words), GROUP):
            group = words[at : at + GROUP]
            ids = self._ids(["".join([" " + word for word in group])])[0]
            ends = np.cumsum([1 + len(word.encode()) for word in group])
            stops = np.searchsorted(np.cumsum(self._bytes_of[np.frombuffer(ids, "<u4")]), ends, "left") + 1
            begin = 0
            for stop in (stops * 4).tolist():
                out.append(ids[begin:stop])
                begin = stop
        return out

    def _learn(self, split: list[list[str]]) -> None:
        """Put the words that are new into the young generation. Those that are empty or end in
        white space get none: a cut after them is not proven."""
        unknown = set(filterfalse(self._young.__contains__, chain.from_iterable(split)))
        if len(self._young) + len(unknown) > GENERATION:
            self._old, self._young = self._young, {}
            unknown = set(chain.from_iterable(split))
        young, old = self._young, self._old
        fresh, stopped = set(), []
        for word in unknown:
            if word in old:
                young[word] = old[word]
            elif not word or word[-1].isspace():
                young[word] = None
            elif STOPPED.fullmatch(word):
                base = word[:-1]
                if base in old:
                    young.setdefault(base, old[base])
                elif base not in young:
                    fresh.add(base)
                stopped.append(word)
            else:
                fresh.add(word)
        fresh = list(fresh)
        young.update(zip(fresh, self._pieces(fresh)))
        young.update((word, young[word[:-1]] + self._stops[word[-1]]) for word in stopped)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of every text, in order; texts are taken some hundred thousand words at a time."""
        known = {text: self._copies[text] for text in texts if text in self._copies}
        held: dict[str, list[str]] = {}
        words = 0

        def settle() -> None:
            known.update(zip(list(held), self._encode(list(held.values()))))
            held.clear()

        for text in texts:
            if text not in known and text not in held:
                held[text] = text.split(" ")
                words += len(held[text])
                if words >= WORDS:
                    settle()
                    words = 0
        settle()
        if len(self._copies) > COPIES:
            self._copies.clear()
        self._copies.update((text, ids) for text, ids in known.items() if len(text) <= COPY_CHARS)
        return [known[text] for text in texts]

    def _encode(self, split: list[list[str]]) -> list[bytes]:
        heads = [words.pop(0) for words in split]
        self._learn(split)
        of = self._young.__getitem__
        out = []
        for head, ids, words in zip(heads, self._ids(heads), split):
            if words and (not head or head[-1].isspace()):
                out.append(self._by_proven_cuts(" ".join([head, *words])))
                continue
            try:
                out.append(ids + b"".join(map(of, words)))
            except TypeError:
                out.append(self._by_proven_cuts(" ".join([head, *words])))
        return out

    def _by_proven_cuts(self, text: str) -> bytes:
        return b"".join(self._ids(STABLE.split(text)))
