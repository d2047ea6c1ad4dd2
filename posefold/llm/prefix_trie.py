"""Prefix trie of rebuilt conversations, from ternary search trees over range shards.

A turn is named by 128 bits of the SHA-256 of role and text, and the byte length of its text. Rebuilt
conversations are range-partitioned by their sequences of such names and by their ids, so equal ones may
lie in several shards and a shared prefix always lies in neighbouring ones. Each shard encodes the names
in a dictionary of its own, puts the distinct sequences into a ternary search tree, the median first, and
accumulates members, leaves and savings from the leaves up. Whatever is not on the path of a shard's
first or last sequence can be in no other shard and is final. The rest, a node per turn of two sequences,
is merged: neighbouring shards in one go, then neighbouring groups of them, until one is left.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posefold.llm.common import stage
from posefold.operators.scale import lookup_join

STEP = 5
HEADS = 9
#: Conversations, and bytes of their names, that one search tree holds; a partition may have many.
SHARD_ROWS = 50_000
SHARD_BYTES = 64 << 20
#: Shards whose boundary nodes are merged in one go.
MERGED = 64
NAME = 24
LEFT, RIGHT = 1, 2
NONE = sha256(b"").hexdigest()
_NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
_EDGE = "kind int, shard bigint, key string, parent string, flags int, bytes bigint"
_FOUND = f"{_EDGE}, {_NODE}, ends_sha256 string, ids binary"
_COLUMNS = [field.split()[0] for field in _FOUND.split(", ")]
_FINAL, _SPINE, _ENDS = 0, 1, 2


def sequences(
    conversations: DataFrame, id_column: str, turn_column: str, role_column: str, text_column: str, step: int, heads: int
) -> DataFrame:
    """``conv_id, names``: every rebuilt conversation, its turns' names one after another."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_column, text_column))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    name = F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(F.octet_length(text).cast("bigint")), 16, "0"))
    turns = conversations.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("bigint").alias("conv_id"), F.col(turn_column).alias("turn"), name.alias("name")
    )
    # One shuffle: conversations that start alike lie together, and each is gathered where it lies.
    turns = turns.withColumn("base", F.col("conv_id") - F.col("conv_id") % step).repartition("base")
    own = turns.groupBy("base", "conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "name"))).alias("own"))
    together = own.select("base", F.struct("conv_id", F.col("own.name").alias("own")).alias("member"))
    together = together.groupBy("base").agg(F.collect_list("member").alias("members"))
    first = F.expr(f"slice(coalesce(get(filter(members, m -> m.conv_id = base), 0).own, array()), 1, {heads - 1})")
    each = together.select(first.alias("first"), F.explode("members").alias("m")).select(
        "m.conv_id", "first", "m.own", (F.crc32(F.col("m.conv_id").cast("string").cast("binary")) % heads).cast("int").alias("h")
    )
    rebuilt = F.expr("concat(slice(first, 1, h), slice(own, h + 1, size(own)))")
    return each.select("conv_id", F.unhex(F.array_join(rebuilt, "")).alias("names"))


def medians(n: int) -> Iterator[int]:
    """0 to n - 1, each range's middle before its halves."""
    left = [(0, n)]
    while left:
        low, high = left.pop()
        if low < high:
            mid = (low + high) // 2
            yield mid
            left += [(mid + 1, high), (low, mid)]


class SearchTree:
    """Ternary search tree of code sequences. Node 0 is the root; a node comes after its trie parent."""

    def __init__(self) -> None:
        self.code, self.low, self.high, self.first = [-1], [-1], [-1], [-1]
        self.parent, self.depth = [-1], [0]

    def _new(self, code: int, parent: int) -> int:
        self.code.append(code)
        self.low.append(-1)
        self.high.append(-1)
        self.first.append(-1)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        return len(self.code) - 1

    def insert(self, codes: list[int]) -> int:
        """The node at which the sequence ends."""
        node = 0
        for code in codes:
            at = self.first[node]
            if at < 0:
                at = self.first[node] = self._new(code, node)
            while (held := self.code[at]) != code:
                side = self.low if code < held else self.high
                if side[at] < 0:
                    side[at] = self._new(code, node)
                at = side[at]
            node = at
        return node


def key_of(names: bytes) -> str:
    return sha256(names).hexdigest()[:32]


def hash_of(ids) -> str:
    return sha256(",".join(map(str, ids)).encode()).hexdigest()


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    types = [kinds[field.split()[1]] for field in _FOUND.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], _COLUMNS)


def search(names: list[bytes], ids: np.ndarray, at: int) -> tuple[list[tuple], list[dict]]:
    """Rows of the final nodes and of the boundary's ends, and the boundary nodes, of one sorted run."""
    begins = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1])]
    distinct = [names[i] for i in begins]
    ends_at = [*begins[1:], len(names)]
    lengths = np.array([len(s) // NAME for s in distinct])
    held, codes = np.unique(np.frombuffer(b"".join(distinct), dtype=f"S{NAME}"), return_inverse=True)
    sizes = np.frombuffer(held.tobytes(), np.uint8).reshape(-1, NAME)[:, 16:].copy().view(">u8").ravel().tolist()
    stops = np.cumsum(lengths)
    tree = SearchTree()
    last = [0] * len(distinct)
    for i in medians(len(distinct)):
        last[i] = tree.insert(codes[stops[i] - lengths[i] : stops[i]].tolist())

    n = len(tree.code)
    convs, least, kids, leaves, saved = [0] * n, [None] * n, [0] * n, [0] * n, [0] * n
    own: dict[int, np.ndarray] = {}
    for i, node in enumerate(last):
        own[node] = ids[begins[i] : ends_at[i]]
        convs[node], least[node] = len(own[node]), int(own[node][0])
    flags = [0] * n
    for side, i in ((LEFT, 0), (RIGHT, len(distinct) - 1)):
        node = last[i]
        while node >= 0:
            flags[node] |= side
            node = tree.parent[node]
    for node in range(n - 1, -1, -1):
        parent = tree.parent[node]
        if not flags[node]:
            leaves[node] = leaves[node] or 1
            saved[node] += (convs[node] - 1) * sizes[tree.code[node]]
            kids[parent] += 1
            leaves[parent] += leaves[node]
            saved[parent] += saved[node]
        if parent >= 0:
            convs[parent] += convs[node]
            least[parent] = least[node] if least[parent] is None else min(least[parent], least[node])

    # A boundary node's sequence is a prefix of the first or of the last one.
    keys: dict[int, str] = {}
    for i in (0, len(distinct) - 1):
        node = last[i]
        while node >= 0 and node not in keys:
            keys[node] = key_of(distinct[i][: tree.depth[node] * NAME])
            node = tree.parent[node]
    rows, spine = [], []
    for node in range(n):
        parent = tree.parent[node]
        if flags[node]:
            size = sizes[tree.code[node]] if node else 0
            spine.append(
                {"key": keys[node], "parent": keys.get(parent), "flags": flags[node], "bytes": size, "depth": tree.depth[node], "conv_id": least[node],
                 "n_convs": convs[node], "n_children": kids[node], "n_leaves": leaves[node], "saved_tokens": saved[node]}
            )
            if node in own:
                rows.append((_ENDS, at, keys[node], None, None, None, *[None] * 8, own[node].astype("<i8").tobytes()))
            continue
        up = (keys[parent], None) if flags[parent] else (None, least[parent])
        node_hash = hash_of(own[node].tolist()) if node in own else NONE
        rows.append(
            (_FINAL, at, None, up[0], 0, None, least[node], tree.depth[node], up[1], convs[node], kids[node], leaves[node], saved[node], node_hash, None)
        )
    return rows, spine


def merged(parts: list[list[dict]], whole: bool) -> tuple[list[dict], list[dict]]:
    """Final nodes, and boundary nodes, of neighbouring runs together; all are final if they are the whole."""
    nodes: dict[str, dict] = {}
    for i, part in enumerate(parts):
        outside = (LEFT if i == 0 else 0) | (RIGHT if i == len(parts) - 1 else 0)
        for row in part:
            flags = row["flags"] & outside
            if (held := nodes.get(row["key"])) is None:
                nodes[row["key"]] = {**row, "flags": flags}
                continue
            held["flags"] |= flags
            held["conv_id"] = min(held["conv_id"], row["conv_id"])
            for name in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                held[name] += row[name]
    final, rest = [], []
    for node in sorted(nodes.values(), key=lambda row: -row["depth"]):
        if node["flags"] and not whole:
            rest.append(node)
            continue
        if not node["n_children"]:
            node["n_leaves"] = 1
        node["saved_tokens"] += (node["n_convs"] - 1) * node["bytes"]
        if node["parent"]:
            parent = nodes[node["parent"]]
            parent["n_children"] += 1
            parent["n_leaves"] += node["n_leaves"]
            parent["saved_tokens"] += node["saved_tokens"]
        final.append(node)
    return final, rest


def _row(kind: int, at: int, node: dict) -> tuple:
    return (kind, at, node["key"], node["parent"], node["flags"], node["bytes"], node["conv_id"], node["depth"], None, *(node[c] for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), None, None)


def _shards(shard_rows: int, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        names, ids, size, number, spine = [], [], 0, 0, None

        def close():
            nonlocal names, ids, size, number, spine
            rows, now = search(names, np.array(ids, dtype=np.int64), part << 32 | number)
            if spine is None:
                spine = now
            else:
                final, spine = merged([spine, now], False)
                rows += [_row(_FINAL, part, node) for node in final]
            names, ids, size, number = [], [], 0, number + 1
            for i in range(0, len(rows), 10_000):
                yield _table(rows[i : i + 10_000])

        for batch in batches:
            for conv, held in zip(batch.column("conv_id").to_pylist(), batch.column("names").to_pylist()):
                names.append(held)
                ids.append(conv)
                size += len(held)
                if len(names) >= shard_rows or size >= shard_bytes:
                    yield from close()
        if names:
            yield from close()
        if spine:
            yield _table([_row(_SPINE, part, node) for node in spine])

    return run


def _merge_round(spines: DataFrame, fan: int, whole: bool) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.astype({"parent": object})
        pdf["parent"] = pdf["parent"].where(pdf["parent"].notna(), None)
        parts = [part.to_dict("records") for _, part in sorted(pdf.drop(columns="group").groupby("shard"))]
        final, rest = merged(parts, whole)
        group = int(pdf.shard.iloc[0]) // fan
        rows = [_row(_FINAL, group, node) for node in final] + [_row(_SPINE, group, node) for node in rest]
        return pd.DataFrame(rows, columns=_COLUMNS).drop(columns=["parent_conv_id", "ends_sha256", "ids"])

    kept = f"{_EDGE}, {_NODE.replace('parent_conv_id bigint, ', '')}"
    names = [field.split()[0] for field in kept.split(", ")]
    keyed = spines.select(*names, F.floor(F.col("shard") / fan).alias("group"))
    return keyed.groupBy("group").applyInPandas(run, kept)


def _hashed(blocks: DataFrame) -> DataFrame:
    """``key, ends_sha256``: blocks of ids in order run through one hash per key; no key is gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            out = []
            for now, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                text = ",".join(map(str, np.frombuffer(ids, "<i8").tolist())).encode()
                if now != key:
                    if key is not None:
                        out.append((key, digest.hexdigest()))
                    key, digest = now, sha256(text)
                else:
                    digest.update(b"," + text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.string()) for i in (0, 1)], ["ends_key", "hash"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], ["ends_key", "hash"])

    ordered = blocks.repartition("key").sortWithinPartitions("key", "shard")
    return ordered.select("key", "ids").mapInArrow(run, "ends_key string, hash string")


def prefix_trie(
    conversations: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    step: int = STEP,
    heads: int = HEADS,
    shard_rows: int = SHARD_ROWS,
    shard_bytes: int = SHARD_BYTES,
    fan: int = MERGED,
) -> DataFrame:
    """One row per trie node: ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``.

    Conversation c is rebuilt from the first h turns of conversation ``c - c % step`` and its own turns
    after its first h, where h is the crc32 of the decimal id modulo ``heads``. Turns ascend, null first; turns
    that share a number follow the digests of role and text, and repeated rows are turns of their own.
    A null role or text is empty. Rows without an id belong to no conversation and are left out.
    ``%`` keeps the sign of the id. An empty table gives no rows, not even a root. Other columns are not
    looked at, whatever their names.

    Memory: a conversation's names, 24 bytes a turn, are in one task at a time, and so are the names of
    ``shard_rows`` conversations or ``shard_bytes`` and their nodes. A group of equal conversations of any
    size is spread over shards; only the digest of its ids, sequential by definition, streams through one task.
    """
    rebuilt = stage(
        sequences(conversations, id_column, turn_column, role_column, text_column, step, heads), "trie-sequences"
    )
    ordered = rebuilt.repartitionByRange("names", "conv_id").sortWithinPartitions("names", "conv_id")
    found = stage(ordered.mapInArrow(_shards(shard_rows, shard_bytes), _FOUND), "trie-shards")

    spines, finals = found.where(f"kind = {_SPINE}"), []
    while True:
        ends = spines.agg(F.min("shard").alias("low"), F.max("shard").alias("high")).first()
        if ends["low"] is None:
            break
        whole = ends["low"] // fan == ends["high"] // fan
        merges = stage(_merge_round(spines, fan, whole), "trie-merge")
        finals.append(merges.where(f"kind = {_FINAL}"))
        if whole:
            break
        spines = merges.where(f"kind = {_SPINE}")

    boundary = found.where(f"kind = {_FINAL} AND key IS NOT NULL").select("key", "parent", *_node_columns())
    for part in finals:
        boundary = boundary.unionByName(part.select("key", "parent", *_node_columns()))
    hashes = _hashed(found.where(f"kind = {_ENDS}"))
    boundary = boundary.join(hashes, F.col("key") == F.col("ends_key"), "left").select(
        "key", "parent", *_node_columns(), F.coalesce("hash", F.lit(NONE)).alias("ends_sha256")
    )
    boundary = stage(boundary, "trie-boundary")
    inner = found.where(f"kind = {_FINAL} AND key IS NULL")
    columns = [*_node_columns(), "ends_sha256"]
    below = inner.where("parent IS NOT NULL").select("parent", *columns).unionByName(boundary.select("parent", *columns).where("parent IS NOT NULL"))
    above = boundary.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    joined = lookup_join(below, above, ["parent"])
    result = joined.unionByName(inner.where("parent IS NULL"), allowMissingColumns=True)
    result = result.unionByName(boundary.where("parent IS NULL"), allowMissingColumns=True)
    return result.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _node_columns() -> list[str]:
    return ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens"]
