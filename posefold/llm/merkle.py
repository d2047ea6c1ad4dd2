"""Merkle manifest of a table: leaves per source, subroots, one root, and a proof for every row.

Hashes are computed where the texts lie; from then on only digests move. A source's leaves are numbered
in order without gathering it, and a superblock is ``FAN ** LEVELS`` of them. Superblocks are reduced to
one node each, their nodes again, until one is left. On the way down every superblock receives what its
leaves need from outside: the siblings of its own node, level by level. Leaves and these outer nodes are
cogrouped, and one pass per superblock reduces it, joins the proofs and folds them.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posefold.llm.common import stage
from posefold.operators.scale import lookup_join, ordinal_within

FAN = 16
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows are tampered with where this divides the crc32 of the decimal id.
TAMPERED = 5
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HEX = 64
_NODES = "tree string, pos bigint, hash string, n bigint"
_OUTER = "tree string, block bigint, outer string, subroot string"


def digest(text: str) -> str:
    return sha256(text.encode("ascii")).hexdigest()


def field(value: Column) -> Column:
    """One input of a leaf: ``-`` for null, else UTF-8 byte count, colon and value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaves(documents: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """``id, tree, leaf, forged`` of every row; ``forged`` is the leaf after tampering, null without it."""
    key, source, *_, text = fields
    small = F.translate(F.col(text).cast("string"), _UPPER, _UPPER.lower())
    whole = F.sha2(F.concat(*(field(F.col(f)) for f in fields)), 256)
    forged = F.sha2(F.concat(*(field(F.col(f)) for f in fields[:-1]), field(small)), 256)
    chosen = F.col(key).isNotNull() & (F.crc32(F.col(key).cast("string").cast("binary")) % TAMPERED == 0)
    return documents.select(
        F.col(key).alias("id"),
        F.coalesce(F.concat(F.lit(":"), F.col(source).cast("string")), F.lit("")).alias("tree"),
        whole.alias("leaf"),
        F.when(chosen, forged).alias("forged"),
    )


def reduced(hashes: list[str], n: int, fan: int, levels: int) -> list[list[str]]:
    """The levels of one superblock, lowest first, of a tree with ``n`` nodes at the lowest."""
    out = [hashes]
    for _ in range(levels):
        if n <= 1:
            break
        below = out[-1]
        out.append([digest("".join(below[i : i + fan])) for i in range(0, len(below), fan)])
        n = -(-n // fan)
    return out


def siblings(tiers: list[list[str]], at: int, fan: int) -> list[tuple[str, str]]:
    """Left and right siblings of node ``at``, joined, at every level below the superblock's own node."""
    out = []
    for tier in tiers[:-1]:
        first, place = at - at % fan, at % fan
        out.append(("".join(tier[first : first + place]), "".join(tier[at + 1 : first + fan])))
        at //= fan
    return out


def packed(path: list[tuple[str, str]]) -> str:
    return ";".join(f"{left},{right}" for left, right in path)


def unpacked(text: str) -> list[tuple[str, str]]:
    return [tuple(level.split(",")) for level in text.split(";")] if text else []


def _above(nodes: DataFrame, fan: int, levels: int) -> DataFrame:
    """One node for every superblock of ``tree, pos, hash, n``."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        n = int(pdf.n.iloc[0])
        top = reduced(pdf["hash"].tolist(), n, fan, levels)[-1][0]
        return pd.DataFrame({"tree": pdf.tree.iloc[:1], "pos": pdf.pos.iloc[:1] // fan**levels, "hash": top, "n": -(-n // fan**levels)})

    return nodes.groupBy("tree", _block(fan, levels)).applyInPandas(run, _NODES)


def _block(fan: int, levels: int) -> Column:
    return F.floor(F.col("pos") / F.lit(fan**levels)).cast("bigint").alias("block")


def _ascent(nodes: DataFrame, fan: int, levels: int) -> list[DataFrame]:
    """``nodes`` and every storey of superblock nodes above them, until each tree has one."""
    storeys = [nodes]
    while True:
        storeys.append(stage(_above(storeys[-1], fan, levels), "merkle-storey"))
        if (storeys[-1].agg(F.max("n")).first()[0] or 0) <= 1:
            return storeys


def _descent(storeys: list[DataFrame], outer: DataFrame, fan: int, levels: int) -> DataFrame:
    """``outer`` of each superblock of the lowest storey, from that of the trees' roots (``block`` 0)."""

    def run(pdf: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty or above.empty:
            return pd.DataFrame({"tree": [], "block": [], "outer": [], "subroot": []}).astype({"block": "int64"})
        pdf = pdf.sort_values("pos")
        tiers = reduced(pdf["hash"].tolist(), int(pdf.n.iloc[0]), fan, levels)
        tail = unpacked(above.outer.iloc[0])
        found = [packed(siblings(tiers, at, fan) + tail) for at in range(len(pdf))]
        return pd.DataFrame({"tree": pdf.tree, "block": pdf.pos, "outer": found, "subroot": above.subroot.iloc[0]})

    for nodes in reversed(storeys[1:-1]):
        keyed = nodes.withColumn("block", _block(fan, levels))
        outer = stage(
            keyed.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(run, _OUTER), "merkle-outer"
        )
    return outer


def manifest(
    documents: DataFrame, fields: tuple[str, ...] = FIELDS, fan: int = FAN, levels: int = LEVELS
) -> DataFrame:
    """One row per document: ``id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``fields`` name the id, the source, further columns and, last, the text. Leaves of a source ascend by
    id, a null id first; rows that share an id follow their leaves' digests, so repeated rows have equal
    leaves and places of their own. Nulls are hashed as such; a null source is a tree of its own, the
    first; a row without an id is never tampered with. A source of one row has its leaf as subroot, and a
    single source its subroot as root. An empty table gives no rows. Other columns are not looked at,
    whatever their names.

    The driver sees the root and one number a storey. A superblock is at most ``fan ** levels`` digests,
    and its outer nodes at most ``fan - 1`` digests a level, however many rows a source holds.
    """
    rows = stage(leaves(documents, fields), "merkle-leaves")
    placed = stage(ordinal_within(rows, ["tree"], ["id", "leaf"], "pos"), "merkle-places")
    sizes = placed.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    placed = lookup_join(placed, sizes, ["tree"], derived=True)
    storeys = _ascent(placed.select("tree", "pos", F.col("leaf").alias("hash"), "n"), fan, levels)

    # The subroots are the nodes of one more tree, and their places in it the ends of all proofs.
    subroots = storeys[-1].select(F.col("tree").alias("source"), F.col("hash"), F.lit("").alias("tree"))
    subroots = stage(ordinal_within(subroots, ["tree"], ["source"], "pos"), "merkle-subroots")
    total = subroots.count()
    upper = subroots.withColumn("n", F.lit(total).cast("bigint"))
    tops = _ascent(upper.select("tree", "pos", "hash", "n"), fan, levels)
    root = tops[-1].first()
    root = root["hash"] if root else ""
    none = tops[-1].select("tree", F.lit(0).cast("bigint").alias("block"), F.lit("").alias("outer"), F.lit("").alias("subroot"))
    blocks = _descent(tops, none, fan, levels)

    def ends(pdf: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        tiers = reduced(pdf["hash"].tolist(), total, fan, levels)
        tail = unpacked(above.outer.iloc[0])
        found = [packed(siblings(tiers, at, fan) + tail) for at in range(len(pdf))]
        return pd.DataFrame({"tree": pdf.source, "block": 0, "outer": found, "subroot": pdf["hash"]})

    keyed = upper.withColumn("block", _block(fan, levels)).groupBy("tree", "block")
    outer = stage(keyed.cogroup(blocks.groupBy("tree", "block")).applyInPandas(ends, _OUTER), "merkle-ends")
    outer = _descent(storeys, outer, fan, levels)

    id_type = rows.schema["id"].dataType.simpleString()

    def proofs(pdf: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        own = pdf.leaf.tolist()
        tiers = reduced(own, int(pdf.n.iloc[0]), fan, levels)
        tail = unpacked(above.outer.iloc[0])
        rest = "".join(left + right for left, right in tail)
        proof, folded = [], []
        for at, (leaf, forged) in enumerate(zip(own, pdf.forged.tolist())):
            path = siblings(tiers, at, fan)
            proof.append(digest("".join(left + right for left, right in path) + rest))
            node = forged or leaf
            for left, right in (*path, *tail):
                node = digest(left + node + right)
            folded.append(node)
        return pd.DataFrame(
            {"id": pdf.id, "leaf": own, "subroot": above.subroot.iloc[0], "root": root, "proof_sha256": proof, "folded_root": folded}
        )

    # As text, for pandas has no whole numbers with nulls.
    keyed = placed.withColumn("id", F.col("id").cast("string")).withColumn("block", _block(fan, levels)).groupBy("tree", "block")
    folded = keyed.cogroup(outer.groupBy("tree", "block")).applyInPandas(
        proofs, "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    )
    return folded.select(
        F.col("id").cast(id_type).alias(fields[0]), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
