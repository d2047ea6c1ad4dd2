"""Registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from posefold.llm.common import table
from posefold.llm.decontaminate import contaminated
from posefold.llm.exact_dedup import dedup_exact
from posefold.llm.html_text import extract_text
from posefold.llm.merkle import manifest
from posefold.llm.packing import pack_documents
from posefold.llm.prefix_trie import prefix_trie
from posefold.llm.quality import classify
from posefold.llm.sharding import shard_by_bytes
from posefold.llm.simhash import near_duplicates
from posefold.llm.token_counts import count_tokens
from posefold.llm.token_files import read_documents, token_folder, write_tokens
from posefold.llm.tool_calls import format_chat
from posefold.llm.toxicity import score_toxicity

QUERIES = {}
ORACLE_SQL: dict[str, str] = {}


def crc32_sql(column: str) -> str:
    """SQL of the unsigned crc32 of a whole number's decimal digits, bit by bit."""
    text = f"CAST({column} AS VARCHAR)"
    bits = f"list_transform(range(0, 8 * length({text})), lambda i: CASE WHEN i % 8 = 0 THEN ascii(substr({text}, i // 8 + 1, 1)) ELSE 0 END::BIGINT)"
    step = "xor(xor(c, x) >> 1, (xor(c, x) & 1) * 3988292384)"
    return f"xor(list_reduce([4294967295::BIGINT] || {bits}, lambda c, x: {step}), 4294967295::BIGINT)"


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_exact(table(spark, sf_dir, "documents"))


ORACLE_SQL["op4_exact_dedup"] = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  row_number() OVER (PARTITION BY body ORDER BY doc_id) = 1 AS kept, sha256(body) AS text_sha256
FROM n WINDOW w AS (PARTITION BY body)
"""


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_folder(spark)
    write_tokens(table(spark, sf_dir, "documents"), path)
    return read_documents(spark, path)


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"))


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


@query
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chat(table(spark, sf_dir, "conversations"))


ORACLE_SQL["op7_chat_format"] = """
WITH t AS (SELECT conv_id, turn, role, text, role = 'assistant' AS is_result FROM conversations),
calls AS (SELECT conv_id, turn, min(role) AS name, min(text) AS text, count(*) AS n_calls FROM t WHERE NOT is_result GROUP BY ALL),
answers AS (SELECT conv_id, turn - 1 AS turn, min(text) AS content, count(*) AS n_results FROM t WHERE is_result GROUP BY ALL),
islands AS (
  SELECT *, sum(begins::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM (
    SELECT *, coalesce(turn - lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) > 2, true) AS begins FROM calls)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id, island ORDER BY turn) - 1 AS level FROM islands),
linked AS (
  SELECT conv_id || ':' || turn AS call_id, name, text, turn, level, n_calls, n_results, content,
    CASE WHEN n_calls IS NULL THEN 'orphan_result' WHEN n_results IS NULL THEN 'unanswered' ELSE 'answered' END AS status,
    CASE WHEN n_calls IS NULL THEN '' WHEN name NOT IN ('user', 'system') THEN 'unknown tool'
      WHEN text IS NULL THEN 'text: missing' WHEN text = '' THEN 'text: beyond the minLength' ELSE '' END AS errors
  FROM placed FULL JOIN answers USING (conv_id, turn))
SELECT call_id, name, status, level, n_calls IS NOT NULL AND errors = '' AS valid, errors,
  coalesce(n_calls, 0) AS n_calls, coalesce(n_results, 0) AS n_results,
  json_object('arguments', CASE WHEN n_calls IS NOT NULL THEN json_object('text', text, 'turn', turn) END, 'call_id', call_id,
    'content', content, 'errors', CASE WHEN errors = '' THEN []::VARCHAR[] ELSE [errors] END, 'level', level, 'name', name,
    'status', status, 'valid', n_calls IS NOT NULL AND errors = '')::VARCHAR AS record
FROM linked
"""


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


ORACLE_SQL["op11_prefix_trie"] = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(text, '') AS text,
    sha256(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS name
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(name ORDER BY turn NULLS FIRST, name) AS names,
    list(octet_length(encode(text)) ORDER BY turn NULLS FIRST, name) AS sizes, {crc32_sql("conv_id")} % 9 AS h
  FROM t GROUP BY conv_id),
rebuilt AS (
  SELECT o.conv_id, coalesce(b.names, [])[1:o.h] || o.names[o.h + 1:] AS names, coalesce(b.sizes, [])[1:o.h] || o.sizes[o.h + 1:] AS sizes
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
places AS (SELECT *, unnest(range(0, len(names) + 1)) AS depth FROM rebuilt),
prefixes AS (
  SELECT conv_id, depth, md5(array_to_string(names[1:depth], ',')) AS key, depth = len(names) AS ends,
    CASE WHEN depth = 0 THEN NULL ELSE md5(array_to_string(names[1:depth - 1], ',')) END AS parent,
    CASE WHEN depth = 0 THEN 0 ELSE sizes[depth] END AS size FROM places),
nodes AS (
  SELECT key, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY key, depth),
families AS (SELECT parent, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
valued AS (SELECT n.*, coalesce(f.n_children, 0) AS n_children FROM nodes n LEFT JOIN families f ON f.parent = n.key),
above AS (
  SELECT DISTINCT v.key, v.n_children, v.n_convs, v.size, a.key AS top
  FROM valued v JOIN prefixes p ON p.key = v.key AND p.depth = v.depth AND p.conv_id = v.conv_id
  JOIN prefixes a ON a.conv_id = p.conv_id AND a.depth <= p.depth),
sums AS (
  SELECT top, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * size)::BIGINT AS saved_tokens FROM above GROUP BY top)
SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, v.ends_sha256
FROM valued v JOIN sums s ON s.top = v.key LEFT JOIN nodes u ON u.key = v.parent
"""


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def _storeys(name: str, tree: str, n: int) -> str:
    """SQL of a tree's levels: ``name`` 0 has ``tree, pos, h, n``; each level adds the siblings of every node."""
    out = []
    for k in range(n):
        out.append(f"""
{name}s{k} AS (
  SELECT *, CASE WHEN n > 1 THEN coalesce(string_agg(h, '') OVER (run ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS l,
    CASE WHEN n > 1 THEN coalesce(string_agg(h, '') OVER (run ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS r
  FROM {name}{k} WINDOW run AS (PARTITION BY {tree}, pos // 16)),
{name}{k + 1} AS (
  SELECT {tree}, pos // 16 AS pos, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE min(h) END AS h, (n + 15) // 16 AS n
  FROM {name}{k} GROUP BY {tree}, pos // 16, n)""")
    return ",".join(out)


def _manifest_sql(levels: int = 6) -> str:
    def field(column: str) -> str:
        text = f"({column})::VARCHAR"
        return f"CASE WHEN {text} IS NULL THEN '-' ELSE octet_length(encode({text}))::VARCHAR || ':' || {text} END"

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    head = " || ".join(map(field, ("doc_id", "source", "lang", "n_chars")))
    joins = "".join(f" JOIN as{k} ON as{k}.tree = f.tree AND as{k}.pos = f.pos // {16**k}" for k in range(levels))
    joins += f" JOIN a{levels} AS own ON own.tree = f.tree JOIN b0 ON b0.tree = f.tree"
    joins += "".join(f" JOIN bs{k} ON bs{k}.pos = b0.pos // {16**k}" for k in range(levels))
    folds, steps = [], [f"as{k}" for k in range(levels)] + [f"bs{k}" for k in range(levels)]
    for i in range(2 * levels):
        folds.append(f"f{i + 1} AS (SELECT *, CASE WHEN m{i} > 1 THEN sha256(l{i} || v{i} || r{i}) ELSE v{i} END AS v{i + 1} FROM f{i})")
    sides = ", ".join(f"{s}.l AS l{i}, {s}.r AS r{i}, {s}.n AS m{i}" for i, s in enumerate(steps))
    proof = " || ".join(f"l{i} || r{i}" for i in range(2 * levels))
    return f"""
WITH leaves AS (
  SELECT doc_id, coalesce(':' || source, '') AS tree, sha256({head} || {field("text")}) AS h,
    CASE WHEN doc_id IS NOT NULL AND {crc32_sql("doc_id")} % 5 = 0
      THEN sha256({head} || {field(f"translate(text, '{upper}', '{upper.lower()}')")}) END AS forged FROM documents),
found AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
a0 AS (SELECT tree, pos, h, n FROM found),{_storeys("a", "tree", levels)},
b0 AS (
  SELECT tree, 0 AS one, row_number() OVER (ORDER BY tree) - 1 AS pos, h, count(*) OVER () AS n FROM a{levels}),{_storeys("b", "one", levels)},
f0 AS (
  SELECT f.doc_id, f.h AS leaf, own.h AS subroot, (SELECT h FROM b{levels}) AS root, coalesce(f.forged, f.h) AS v0, {sides}
  FROM found f{joins}),
{", ".join(folds)}
SELECT doc_id, leaf, subroot, root, sha256({proof}) AS proof_sha256, v{2 * levels} AS folded_root, v{2 * levels} = root AS verified FROM f{2 * levels}
"""


ORACLE_SQL["op12_merkle_manifest"] = _manifest_sql()


@query
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
