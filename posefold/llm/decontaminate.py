"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items that share a run of ``least`` tokens, a seed, meet in a hash join; seeds
that could not cover enough of an item drop the pair. For the pairs left, running Karp-Rabin finds the
longest matches of unmarked tokens, marks those that do not overlap, and goes on with shorter ones down
to ``least``. The tiles' share of the item is its coverage, whatever order the tiles have in the document.

Benchmark items travel to the documents in blocks of bounded size, so that no document is shuffled.
"""

from __future__ import annotations

import heapq
import string
import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posefold.llm.common import filtered, slices, stage, text_or_empty

LEAST_MATCH = 4
COVERAGE = 0.6
FIRST_SEARCH = 32
#: Pairs of places that wait in memory at once; the result does not depend on it.
MOST_MATCHES = 100_000
BLOCK_BYTES = 8_000_000
RESULT = (
    "id {}, item_id bigint, item_tokens int, covered_tokens int, coverage double,"
    " tiles array<struct<item_start:int,doc_start:int,length:int>>"
)
_SPACED = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
_FEW_BITS = 20
_PRIME = 0x9E3779B97F4A7C15
_INVERSE = pow(_PRIME, -1, 1 << 64)
_indexes: dict[str, "Index"] = {}


def tokens(text: str) -> list[bytes]:
    """Lower-case words; ASCII punctuation counts as white space."""
    return text.lower().encode().translate(_SPACED).split()


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Rolling:
    """Hashes of all windows of one width, from one running sum, for any width."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        terms = (values.astype(np.int64) + 2).astype(np.uint64) * _powers(_INVERSE, n)
        self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        self._lift = _powers(_PRIME, n)

    def windows(self, width: int) -> np.ndarray:
        n = len(self._lift) - width + 1
        return (self._sums[width:] - self._sums[:-width]) * self._lift[:n] if n > 0 else np.zeros(0, np.uint64)


def greedy_tiles(item: np.ndarray, text: np.ndarray, least: int, first: int = FIRST_SEARCH) -> list[tuple[int, int, int]]:
    """``(item_start, text_start, length)`` of greedy string tiling; negative tokens match nothing.

    Always the longest match of unmarked tokens is marked next; of equal ones the first in the item, then
    in the text. Matches that share windows of the search length wait in a heap by length; one that an
    earlier tile has cut short goes back with what is left of it. Where a passage repeats so often that
    ``MOST_MATCHES`` would wait, ``_longest`` finds one match after another in memory of one row.
    """
    a, b = item.tolist(), text.tolist()
    marked_a, marked_b = np.zeros(len(a), dtype=bool), text < 0
    rolling_a, rolling_b = Rolling(item), Rolling(text)
    tiles, search = [], max(least, min(first, len(a)))

    def extent(i: int, j: int) -> int:
        length = 0
        while (
            i + length < len(a) and j + length < len(b) and a[i + length] == b[j + length]
            and not marked_a[i + length] and not marked_b[j + length]
        ):
            length += 1
        return length

    def mark(i: int, j: int, length: int) -> None:
        marked_a[i : i + length] = marked_b[j : j + length] = True
        tiles.append((i, j, length))

    while True:
        wanted = np.where(_free(marked_a, search), rolling_a.windows(search), 0)
        have = rolling_b.windows(search)
        places = np.flatnonzero(np.isin(have, wanted) & _free(marked_b, search))
        codes, times = np.unique(have[places], return_counts=True)
        spots = np.searchsorted(codes, wanted)
        known = spots < len(codes)
        known[known] = codes[spots[known]] == wanted[known]
        if times[spots[known]].sum() > MOST_MATCHES:
            while (found := _longest(item, text, marked_a, marked_b))[2] >= search:
                mark(*found)
        else:
            where: dict[int, list[int]] = {}
            for place, code in zip(places.tolist(), have[places].tolist()):
                where.setdefault(code, []).append(place)
            starts = np.flatnonzero(known)
            waiting = [(-extent(i, j), i, j) for i, code in zip(starts.tolist(), wanted[starts].tolist()) for j in where[code]]
            waiting = [match for match in waiting if -match[0] >= search]
            if waiting and -min(waiting)[0] > 2 * search:
                search = -min(waiting)[0]
                continue
            heapq.heapify(waiting)
            while waiting:
                length, i, j = heapq.heappop(waiting)
                if (left := extent(i, j)) == -length:
                    mark(i, j, left)
                elif left >= search:
                    heapq.heappush(waiting, (-left, i, j))
        if search == least:
            return tiles
        search = max(least, search // 2)


def _free(marked: np.ndarray, width: int) -> np.ndarray:
    """Whether each window of the width is unmarked throughout."""
    taken = np.concatenate([[0], np.cumsum(marked)])
    return taken[width:] == taken[: max(0, len(taken) - width)]


def _longest(item: np.ndarray, text: np.ndarray, marked_a: np.ndarray, marked_b: np.ndarray) -> tuple[int, int, int]:
    """The first longest match of unmarked tokens: a row of match lengths an item token, the last one first."""
    open_text = np.where(marked_b, -1, text)
    after, best = np.zeros(len(text) + 1, dtype=np.int32), (0, 0, 0)
    for i in range(len(item) - 1, -1, -1):
        lengths = np.zeros(len(text) + 1, dtype=np.int32)
        if not marked_a[i]:
            np.multiply(after[1:] + 1, open_text == item[i], out=lengths[:-1])
            j = int(lengths.argmax())
            if lengths[j] and lengths[j] >= best[2]:
                best = (i, j, int(lengths[j]))
        after = lengths
    return best


class Index:
    """Benchmark items as numbers, and which items have which seed."""

    def __init__(self, items: list[tuple[int, str]], least: int):
        self.least = least
        self.numbers: dict[bytes, int] = {}
        self.items = []
        seeds: dict[int, dict[int, list[int]]] = {}
        for item_id, text in items:
            words = tokens(text)
            if not words:
                continue
            codes = np.array([self.numbers.setdefault(w, len(self.numbers)) for w in words])
            width = min(least, len(codes))
            for code in set(Rolling(codes).windows(width).tolist()):
                seeds.setdefault(width, {}).setdefault(code, []).append(len(self.items))
            self.items.append((item_id, codes, width))
        self.seeds = {}
        for width, found in seeds.items():
            # A bit for the leading bits of every seed tells most other windows off at once.
            few = np.zeros(1 << _FEW_BITS, dtype=bool)
            few[np.array(list(found), dtype=np.uint64) >> np.uint64(64 - _FEW_BITS)] = True
            self.seeds[width] = (few, found)

    def matches(self, text: str, coverage: float) -> Iterator[tuple[int, int, int, float, list[tuple[int, int, int]]]]:
        words = tokens(text)
        codes = np.fromiter(map(self.numbers.get, words, repeat(-1)), np.int64, len(words))
        known = codes >= 0
        for width, (few, items) in self.seeds.items():
            if len(codes) < width:
                continue
            # Windows all of whose tokens occur in the benchmark.
            whole = known[: len(codes) - width + 1].copy()
            for k in range(1, width):
                whole &= known[k : len(codes) - width + 1 + k]
            windows = np.flatnonzero(whole)
            sums = np.zeros(len(windows), dtype=np.uint64)
            for k in reversed(range(width)):
                sums = sums * np.uint64(_INVERSE) + (codes[windows + k] + 2).astype(np.uint64)
            maybe = np.flatnonzero(few[sums >> np.uint64(64 - _FEW_BITS)])
            by_item: dict[int, list[int]] = {}
            for place, code in zip(windows[maybe].tolist(), sums[maybe].tolist()):
                for item in items.get(code, ()):
                    by_item.setdefault(item, []).append(place)
            for item, places in by_item.items():
                yield from self._tile(item, np.array(places), codes, coverage)

    def _tile(self, item: int, places: np.ndarray, codes: np.ndarray, coverage: float):
        item_id, wanted, width = self.items[item]
        # Tiles lie where seeds of this item do; the other tokens are left out, with a gap for each stretch.
        inside = np.zeros(len(codes), dtype=bool)
        for k in range(width):
            inside[places + k] = True
        kept = np.flatnonzero(inside)
        gaps = np.flatnonzero(np.diff(kept) > 1) + 1
        near = np.insert(codes[kept], gaps, -1)
        back = np.insert(kept, gaps, -1)
        if np.isin(wanted, near).sum() < coverage * len(wanted):
            return
        tiles = greedy_tiles(wanted, near, width)
        covered = sum(length for _, _, length in tiles)
        if covered >= coverage * len(wanted):
            yield item_id, len(wanted), covered, covered / len(wanted), [(i, int(back[j]), n) for i, j, n in sorted(tiles)]


def _blocks(benchmark: DataFrame, most: int) -> Iterator[list[tuple[int, str]]]:
    """The items a block at a time; the driver holds one block of bounded size."""
    held, size = [], 0
    for item_id, text in benchmark.toLocalIterator():
        if held and size + len(text) > most:
            yield held
            held, size = [], 0
        held.append((item_id, text))
        size += len(text) + 64
    if held:
        yield held


def _index(name: str, block, least: int) -> Index:
    """A worker's index of a broadcast block; it keeps the last one it has built."""
    if name not in _indexes:
        _indexes.clear()
        _indexes[name] = Index(block.value, least)
    return _indexes[name]


def clean_documents(
    documents: DataFrame, benchmark: DataFrame, least: int = LEAST_MATCH, coverage: float = COVERAGE, text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows, with all their columns, that no benchmark item contaminates (see ``contaminated``)."""
    items = benchmark.select(F.col(item_column).cast("bigint"), F.col(item_text_column)).where(F.col(item_text_column).isNotNull())

    def clean(block):
        name = uuid.uuid4().hex
        return lambda texts: [not any(True for _ in _index(name, block, least).matches(t, coverage)) for t in texts]

    left = documents
    for i, block in enumerate(_blocks(items, block_bytes)):
        # Each block filters what the one before has left; staged, so that only one index is alive.
        left = stage(left, "clean") if i else left
        left = filtered(left, text_column, clean(documents.sparkSession.sparkContext.broadcast(block)))
    return left


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    least: int = LEAST_MATCH,
    coverage: float = COVERAGE,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """A row for every document and item whose tiles cover at least ``coverage`` of the item's tokens:
    ``id, item_id, item_tokens, covered_tokens, coverage, tiles``; places are token numbers.

    A tile has ``least`` tokens, or all of an item that is shorter. Null and tokenless texts match
    nothing, on either side; null ids and repeated rows give rows of their own; an empty table gives
    none. Other columns are not looked at, whatever their names.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("body"))
    schema = RESULT.format(rows.schema["id"].dataType.simpleString())
    items = benchmark.select(F.col(item_column).cast("bigint"), F.col(item_text_column)).where(F.col(item_text_column).isNotNull())
    tile = pa.struct([("item_start", pa.int32()), ("doc_start", pa.int32()), ("length", pa.int32())])

    def matched(block):
        name = uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index(name, block, least)
            for batch in slices(batches):
                found = [
                    (i, *row) for i, text in enumerate(batch.column("body").to_pylist()) for row in index.matches(text, coverage)
                ]
                if not found:
                    continue
                at, *columns = zip(*found)
                tiles = [[dict(zip(("item_start", "doc_start", "length"), t)) for t in own] for own in columns[4]]
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(at)), *(pa.array(c, k) for c, k in zip(columns, kinds)), pa.array(tiles, pa.list_(tile))],
                    ["id", "item_id", "item_tokens", "covered_tokens", "coverage", "tiles"],
                )

        return run

    parts = []
    for block in _blocks(items, block_bytes):
        shared = spark.sparkContext.broadcast(block)
        found = rows.mapInArrow(matched(shared), schema)
        # Several blocks are run one after the other, so that only one is alive.
        parts.append(found if len(parts) == 0 and sum(len(t) for _, t in block) < block_bytes // 2 else stage(found, "matches"))
    result = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)
    return result.withColumnRenamed("id", id_column)
