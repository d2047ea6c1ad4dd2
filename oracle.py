"""DuckDB SQL that states every registered query's result in another way.

Kinematics is composed from quaternions here, where the Spark side multiplies matrices. The strings
are assembled from named CTEs; each query pulls in only what it uses.
"""

from __future__ import annotations

import math
import re

# The arm's chain, as (offset, rotation wxyz) per joint and for the site.
CHAIN = (
    ((0, 0, 0.0631), (1, 0, 0, 1)),
    ((2.5e-05, -0.02, 0.0409), (1, 1, 1, 1)),
    ((0.264, 0, 0), (0, 1, 0, 0)),
    ((-0.245, -0.06, 0), (1, 0, 0, 0)),
    ((-0.074, -0.0395, 2.5e-05), (1, -1, 1, 1)),
    ((0, 0.0353, 0.0395), (1, -1, 0, 0)),
    ((0, 0, 0.1347), (1, 0, 0, -1)),
)
LIMITS = (
    (-2.61799, 3.05433), (0, 3.66519), (0, 3.66519), (-1.5708, 1.5708), (-1.5708, 1.5708), (-2.0944, 2.0944),
)
TOPICS = ("/left-arm-state", "/right-arm-state", "/left-arm-action", "/right-arm-action")
TOPIC_LIST = ", ".join(f"'{t}'" for t in TOPICS)
ARM = "CASE WHEN topic LIKE '/left-arm-%' THEN 'left' WHEN topic LIKE '/right-arm-%' THEN 'right' END"
STREAM = "CASE WHEN topic LIKE '%-state' THEN 'state' WHEN topic LIKE '%-action' THEN 'action' END"
Q = ("qw", "qx", "qy", "qz")
POSE7 = ("x", "y", "z", *Q)


def r(text: str, places: int = 9) -> str:
    return f"round({text}, {places}) + 0.0::DOUBLE"


def d(value: float) -> str:
    return f"({value!r})::DOUBLE"


def quaternion_product(a: tuple, b: tuple) -> list[str]:
    w1, x1, y1, z1 = a
    w2, x2, y2, z2 = b
    return [
        f"({w1}*{w2} - {x1}*{x2} - {y1}*{y2} - {z1}*{z2})",
        f"({w1}*{x2} + {x1}*{w2} + {y1}*{z2} - {z1}*{y2})",
        f"({w1}*{y2} - {x1}*{z2} + {y1}*{w2} + {z1}*{x2})",
        f"({w1}*{z2} + {x1}*{y2} - {y1}*{x2} + {z1}*{w2})",
    ]


def matrix_entries(q: tuple = Q) -> list[list[str]]:
    w, x, y, z = q
    return [
        [f"(1 - 2*({y}*{y} + {z}*{z}))", f"(2*({x}*{y} - {w}*{z}))", f"(2*({x}*{z} + {w}*{y}))"],
        [f"(2*({x}*{y} + {w}*{z}))", f"(1 - 2*({x}*{x} + {z}*{z}))", f"(2*({y}*{z} - {w}*{x}))"],
        [f"(2*({x}*{z} - {w}*{y}))", f"(2*({y}*{z} + {w}*{x}))", f"(1 - 2*({x}*{x} + {y}*{y}))"],
    ]


def fk_ctes(name: str, source: str, first: int) -> dict[str, str]:
    """CTEs ending in ``name(vec_id, x, y, z, qw .. qz)``: FK of ``source``'s ``e[first .. first+5]``."""
    steps: dict[str, str] = {}
    angles = ", ".join(f"e[{first + i}] AS t{i}" for i in range(6))
    steps[f"{name}_0"] = (
        f"SELECT vec_id, {angles}, 0::DOUBLE AS x, 0::DOUBLE AS y, 0::DOUBLE AS z,"
        f" 1::DOUBLE AS qw, 0::DOUBLE AS qx, 0::DOUBLE AS qy, 0::DOUBLE AS qz FROM {source}"
    )
    for i, (offset, rotation) in enumerate(CHAIN):
        norm = math.sqrt(sum(v * v for v in rotation))
        fixed = tuple(d(v / norm) for v in rotation)
        m = matrix_entries()
        moved = [f"{axis} + " + " + ".join(f"{m[k][j]}*{d(offset[j])}" for j in range(3)) for k, axis in enumerate("xyz")]
        turned = quaternion_product(Q, fixed)
        ts = "".join(f"t{k}, " for k in range(6))
        body = ", ".join(f"{text} AS {n}" for n, text in zip(POSE7, [*moved, *turned]))
        steps[f"{name}_{i}c"] = f"SELECT vec_id, {ts}{body} FROM {name}_{i}"
        if i < 6:
            spin = (f"cos(t{i}/2)", "0::DOUBLE", "0::DOUBLE", f"sin(t{i}/2)")
            spun = quaternion_product(Q, spin)
            body = ", ".join(["x", "y", "z", *(f"{text} AS {n}" for n, text in zip(Q, spun))])
            steps[f"{name}_{i + 1}"] = f"SELECT vec_id, {ts}{body} FROM {name}_{i}c"
    norm = "sqrt(qw*qw + qx*qx + qy*qy + qz*qz)"
    unit = ", ".join(f"sign_*{n}/{norm} AS {n}" for n in Q)
    steps[name] = (
        f"SELECT vec_id, x, y, z, {unit} FROM (SELECT *, CASE WHEN qw < 0 THEN -1 ELSE 1 END AS sign_ FROM {name}_6c)"
    )
    return steps


def matrix_list(scale: str = "", first: str = "", x: str = "x") -> str:
    m = matrix_entries()
    rows = [f"{first}{m[i][0]}{scale}, {m[i][1]}{scale}, {m[i][2]}{scale}, {t}" for i, t in enumerate((x, "yy", "z"))]
    return f"[{', '.join(rows)}, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE, 1::DOUBLE]"


def slot(i: int, value: str, base: str = "clean") -> str:
    return f"list_concat({base}[1:{i - 1}], [{value}], {base}[{i + 1}:])"


NAN, INF = "'NaN'::DOUBLE", "'Infinity'::DOUBLE"
TWO = "lpad(ep::VARCHAR, greatest(8, length(ep::VARCHAR))::INT, '0')"
PATH = f"'data/val/task_' || {TWO} || '/episode_' || {TWO} || '/episode.fo.mcap'"
EP_OF = "regexp_extract({0}, 'episode_(\\d+)/', 1)::INT"

CTES: dict[str, str] = {
    "emb": "SELECT vec_id, list_transform(embedding[1:28], lambda v: v::DOUBLE * 3) AS e FROM embeddings"
    "",
    "ev": "SELECT event_id, user_id, event_type, epoch_us(ts) AS us, event_id % (SELECT max(vec_id) + 1 FROM embeddings) AS vec_id, user_id AS ep, props,"
    " event_id % 20 AS h, (event_id // 20) % 10 AS g FROM events",
    **fk_ctes("fkm", "emb", 17),
    "placed": f"""SELECT ev.*, {PATH} AS path, 'fx://' || {PATH} AS source_uri,
  CASE event_type WHEN 'view' THEN '{TOPICS[0]}' WHEN 'click' THEN '{TOPICS[1]}' WHEN 'purchase' THEN '{TOPICS[2]}'
    WHEN 'signup' THEN CASE WHEN ep = 9 THEN '/camera/top' ELSE '{TOPICS[3]}' END WHEN 'error' THEN '/camera/top' END AS topic,
  ep % 5 = 4 AS dirty, ep % 5 = 4 AND event_id % 97 = 0 AS undecodable FROM ev""",
    "based": """SELECT p.*, e.e[17:22] AS q, f.x, f.y, f.z, f.qw, f.qx, f.qy, f.qz,
  f.y + CASE WHEN topic NOT LIKE '/right-arm-%' THEN 0 WHEN ep % 16 = 3 THEN -0.8 ELSE -0.61 END::DOUBLE AS yy
  FROM placed p JOIN fkm f USING (vec_id) JOIN emb e USING (vec_id)""",
    "cleaned": f"SELECT *, {matrix_list()} AS clean, {matrix_list(scale=' * 1.01::DOUBLE')} AS scaled,"
    f" {matrix_list(first='-')} AS flipped, {matrix_list(x='x + 0.02::DOUBLE')} AS shifted FROM based",
    "msg": f"""SELECT source_uri, path, ep, vec_id, topic, us * 1000 AS log_time_ns, us * 1000 - 10000 AS publish_time_ns, event_id AS sequence,
  {ARM} AS arm, {STREAM} AS stream,
  CASE WHEN undecodable THEN 'decode_error' WHEN topic IN ({TOPIC_LIST}) THEN 'target' ELSE 'ignored' END AS role,
  CASE WHEN undecodable THEN NULL WHEN ep % 5 = 0 THEN []::DOUBLE[] WHEN NOT dirty THEN clean ELSE CASE h
    WHEN 0 THEN []::DOUBLE[] WHEN 1 THEN NULL WHEN 2 THEN clean[1:15] WHEN 3 THEN list_concat(clean, [1::DOUBLE])
    WHEN 4 THEN {slot(1, NAN)} WHEN 5 THEN {slot(1, INF)} WHEN 6 THEN {slot(1, 'NULL::DOUBLE')}
    WHEN 7 THEN {slot(13, '0.5::DOUBLE')} WHEN 8 THEN scaled WHEN 9 THEN flipped WHEN 10 THEN {slot(13, '5e-6::DOUBLE')}
    WHEN 11 THEN shifted ELSE clean END END AS pose,
  CASE WHEN undecodable THEN NULL WHEN NOT dirty THEN q ELSE CASE g WHEN 0 THEN q[1:5] WHEN 1 THEN []::DOUBLE[] WHEN 2 THEN NULL
    WHEN 3 THEN {slot(1, NAN, 'q')} WHEN 4 THEN {slot(1, 'NULL::DOUBLE', 'q')} ELSE q END END AS position
  FROM cleaned""",
    "flags": """SELECT *, coalesce(len(pose), 0) AS np, coalesce(len(position), 0) AS nj,
  len(list_filter(pose, lambda v: v IS NOT NULL AND isfinite(v))) AS fp,
  len(list_filter(position, lambda v: v IS NOT NULL AND isfinite(v))) AS fj FROM msg""",
    "solid": """SELECT *, CASE WHEN np = 16 AND fp = 16 THEN pose ELSE [1,0,0,0,0,1,0,0,0,0,1,0,0,0,0,1]::DOUBLE[] END AS m FROM flags""",
    "cls": """SELECT *, CASE WHEN np = 0 THEN 'missing' WHEN np <> 16 THEN 'malformed' WHEN fp <> 16 THEN 'nonfinite'
    WHEN greatest(abs(m[13]), abs(m[14]), abs(m[15]), abs(m[16] - 1)) > 1e-5 THEN 'malformed'
    WHEN greatest(
      abs(m[1]*m[1] + m[5]*m[5] + m[9]*m[9] - 1), abs(m[2]*m[2] + m[6]*m[6] + m[10]*m[10] - 1),
      abs(m[3]*m[3] + m[7]*m[7] + m[11]*m[11] - 1), abs(m[1]*m[2] + m[5]*m[6] + m[9]*m[10]),
      abs(m[1]*m[3] + m[5]*m[7] + m[9]*m[11]), abs(m[2]*m[3] + m[6]*m[7] + m[10]*m[11])) > 1e-4 THEN 'malformed'
    WHEN abs(m[1]*(m[6]*m[11] - m[7]*m[10]) - m[2]*(m[5]*m[11] - m[7]*m[9]) + m[3]*(m[5]*m[10] - m[6]*m[9]) - 1) > 1e-4
      THEN 'malformed' ELSE 'intact' END AS pose_status,
  CASE WHEN nj = 0 THEN 'missing' WHEN nj <> 6 THEN 'malformed' WHEN fj <> 6 THEN 'nonfinite' ELSE 'intact' END AS joint_status
  FROM solid""",
    "tgt": "SELECT * FROM cls WHERE role = 'target'",
    "joined": """SELECT c.*, f.x, f.y, f.z, f.qw, f.qx, f.qy, f.qz FROM cls c LEFT JOIN fkm f USING (vec_id)""",
    "res0": f"""SELECT *, role = 'target' AND joint_status = 'intact' AS fk_ok, role = 'target' AND joint_status = 'intact' AND pose_status = 'intact' AS cmp,
  ({' + '.join(f'{matrix_entries()[i][j]}*m[{4 * i + j + 1}]' for i in range(3) for j in range(3))}) AS tr,
  m[4] - x AS ox, m[8] - y AS oy, m[12] - z AS oz FROM joined""",
    "res1": """SELECT *, CASE WHEN cmp THEN sqrt(ox*ox + (oy + CASE WHEN arm = 'right' THEN 0.61 ELSE 0 END::DOUBLE)**2 + oz*oz) END AS tm,
  CASE WHEN cmp THEN degrees(acos(greatest(-1, least(1, (tr - 1)/2)))) END AS rd FROM res0""",
    "scored": "SELECT *, coalesce(tm > 1e-5 OR rd > 1e-3, false) AS outside FROM res1",
    "sources": "SELECT DISTINCT source_uri FROM msg",
    "tdim": "SELECT * FROM (VALUES " + ", ".join(f"('{t}', {i})" for i, t in enumerate(TOPICS)) + ") AS v(topic, topic_order)",
}
COUNTS = {
    "messages": "count(*) FILTER (role = 'target')",
    **{f"{s}_pose": f"count(*) FILTER (role = 'target' AND pose_status = '{s}')" for s in ("missing", "malformed", "nonfinite", "intact")},
    "recoverable_invalid_pose": "count(*) FILTER (role = 'target' AND pose_status <> 'intact' AND fk_ok)",
    "unrecoverable_invalid_pose": "count(*) FILTER (role = 'target' AND pose_status <> 'intact' AND NOT fk_ok)",
    **{f"{s}_joints": f"count(*) FILTER (role = 'target' AND joint_status = '{s}')" for s in ("missing", "malformed", "nonfinite")},
    "fk_failures": "0::BIGINT",
    "fk_compared": "count(tm)",
    "fk_outside_tolerance": "count(*) FILTER (outside)",
}
OFFSETS = {"offset_count": "count(*) FILTER (cmp)"} | {
    f"offset_{kind}_{a}": f"{fn}(o{a}) FILTER (cmp)"
    for a in "xyz"
    for kind, fn in (("mean", "avg"), ("std", "stddev_pop"), ("min", "min"), ("max", "max"))
}
RESIDUALS = {
    "translation_mean_m": r("avg(tm)"), "translation_rmse_m": r("sqrt(avg(tm*tm))"), "translation_max_m": r("max(tm)"),
    "rotation_mean_deg": r("avg(rd)", 4), "rotation_rmse_deg": r("sqrt(avg(rd*rd))", 4), "rotation_max_deg": r("max(rd)", 4),
}


def cols(items: dict[str, str]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in items.items())


def rcols(items: dict[str, str]) -> str:
    return ", ".join(f"{text if name.endswith('count') else r(text)} AS {name}" for name, text in items.items())


INVALID = "missing_pose + malformed_pose + nonfinite_pose"
BADJ = "missing_joints + malformed_joints + nonfinite_joints"
CTES["files0"] = (
    f"SELECT source_uri, {cols(COUNTS)}, count(*) FILTER (role = 'ignored') AS ignored_messages,"
    " count(*) FILTER (role = 'decode_error') AS decode_errors,"
    " 4 - count(DISTINCT CASE WHEN role = 'target' THEN topic END) AS missing_topic_count FROM scored GROUP BY source_uri"
)
CTES["files"] = (
    f"SELECT *, 0::BIGINT AS unclassified_topics, 0::BIGINT AS offset_mismatch_topics, {INVALID} AS invalid_pose,"
    f" {BADJ} AS invalid_joints, {INVALID} + {BADJ} + fk_failures + fk_outside_tolerance + decode_errors AS issue_count,"
    f" missing_topic_count = 0 AND decode_errors = 0 AND fk_outside_tolerance = 0 AND {INVALID} = 0 AND {BADJ} = 0 AS passed"
    " FROM files0"
)
CTES["right"] = (
    f"SELECT s.source_uri, {cols(OFFSETS)} FROM sources s LEFT JOIN (SELECT * FROM scored WHERE arm = 'right' AND role = 'target') c"
    " USING (source_uri) GROUP BY s.source_uri"
)
CTES["cohort"] = "SELECT *, " + ", ".join(
    f"CASE WHEN offset_count > 0 THEN round_even(offset_mean_{a}, 2) + 0.0::DOUBLE END AS cohort_{a}" for a in "xyz"
) + " FROM right_"
CTES["right_"] = CTES.pop("right")
CTES["rec"] = f"""SELECT *, CASE WHEN joint_status = 'intact' THEN 'derived' ELSE 'not_attempted_invalid_joints' END AS fk_status,
  CASE WHEN joint_status = 'intact' AND pose_status = 'intact' THEN 'source_pose_intact' WHEN joint_status = 'intact' THEN 'recovered'
    WHEN pose_status = 'intact' THEN 'source_pose_intact_invalid_joints' ELSE 'unrecoverable_invalid_joints' END AS recovery_status,
  (CASE WHEN pose_status = 'intact' THEN 1 ELSE 0 END + CASE WHEN joint_status = 'intact' THEN 6 ELSE 0 END
    + CASE WHEN joint_status = 'intact' AND pose_status <> 'intact' THEN 8 ELSE 0 END)::BIGINT AS status_mask FROM joined WHERE role = 'target'"""
CTES["eps"] = f"SELECT *, sha256(path || ':' || mark) AS lfs_oid, substr(sha256('git' || path || ':' || mark), 1, 40) AS oid FROM (SELECT ep, count(*) AS n_events, sum(event_id)::BIGINT AS mark, (1000 + sum(strlen(props)))::BIGINT AS size, {PATH} AS path, 'fx://' || {PATH} AS source_uri, 'task_' || {TWO} AS task, 'episode_' || {TWO} AS episode_id FROM ev GROUP BY ep)"
CTES["chan0"] = "SELECT source_uri, path, ep, topic, count(*) AS n FROM placed GROUP BY ALL"
CTES["chan"] = f"SELECT * FROM chan0 UNION ALL SELECT source_uri, path, ep, topic || '.plot', n FROM chan0 WHERE topic IN ({TOPIC_LIST})"
CTES["summ"] = "SELECT source_uri, ep, sum(n)::BIGINT AS all_messages, coalesce(sum(n) FILTER (topic LIKE '%.plot'), 0)::BIGINT AS plot_messages FROM chan GROUP BY ALL"
LIMBS = (("observation_left_arm_pose", "s", 1, 1), ("observation_right_arm_pose", "s", 8, 8), ("action_left_arm_pose", "a", 1, 15), ("action_right_arm_pose", "a", 8, 22))
for _i, (_n, _v, _s, _first) in enumerate(LIMBS):
    CTES |= fk_ctes(f"fkl{_i}", "emb", _first)
CTES["frm"] = f"""SELECT event_id AS source_row, user_id AS episode_index, us / 1e6::DOUBLE AS timestamp, vec_id,
  CASE event_id % 11 WHEN 1 THEN {slot(7, NAN, 'e[1:14]')} WHEN 2 THEN e[1:13] WHEN 4 THEN {slot(1, 'NULL::DOUBLE', 'e[1:14]')} ELSE e[1:14] END AS s,
  CASE event_id % 11 WHEN 0 THEN {slot(10, NAN, 'e[15:28]')} WHEN 3 THEN NULL ELSE e[15:28] END AS a
  FROM ev JOIN emb USING (vec_id)"""
CTES["ok"] = "SELECT *, " + ", ".join(
    f"coalesce(len({v}) = 14 AND len(list_filter({v}[{s}:{s + 5}], lambda v: v IS NOT NULL AND isfinite(v))) = 6, false) AS ok{i}"
    for i, (_, v, s, _f) in enumerate(LIMBS)
) + " FROM frm"
VALID = " + ".join(f"CASE WHEN ok{i} THEN {1 << i} ELSE 0 END" for i in range(4))
CTES["masks"] = f"SELECT *, ({VALID})::BIGINT AS valid_mask, (15 - ({VALID}))::BIGINT AS invalid_input_mask FROM ok"


def sql(body: str, **extra: str) -> str:
    """Prefix ``body`` with the CTEs it needs, in dependency order."""
    known = CTES | extra
    order: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"[A-Za-z_][A-Za-z_0-9]*", text):
            if word in known and word not in order and word not in visiting:
                visiting.add(word)
                visit(known[word])
                order.append(word)

    visiting: set[str] = set()
    visit(body)
    # Names of columns can equal names of CTEs; an unused CTE does no harm.
    return "WITH " + ",\n".join(f"{name} AS ({known[name]})" for name in order) + "\n" + body


CLASS = "CASE WHEN recovery_status LIKE 'source_pose_intact%' THEN 'o' WHEN recovery_status = 'recovered' THEN 'd' ELSE 'f' END"
RELEASE = f"""SELECT source_uri, messages, CASE WHEN invalid_pose = 0 THEN 'intact' WHEN missing_pose = messages AND recoverable_invalid_pose = messages
  THEN 'selected' ELSE 'refused' END AS decision,
  CASE WHEN invalid_pose = 0 THEN NULL WHEN invalid_pose <> messages THEN 'mixed_intact_and_invalid'
    WHEN recoverable_invalid_pose <> messages THEN 'not_all_recoverable' WHEN missing_pose <> messages THEN 'not_literally_missing' END AS reason,
  {EP_OF.format('source_uri')} % 5 <> 4 AS clean FROM files"""
CTES["releases"] = RELEASE
SERIES = f"""SELECT source_uri, arm, topic, sequence, log_time_ns, pose[4] AS rx, pose[8] AS ry, pose[12] AS rz, x AS dx,
  y + CASE WHEN arm = 'right' THEN -0.61 ELSE 0 END::DOUBLE AS dy, z AS dz,
  joint_status = 'intact' AND isfinite(pose[4]) AND isfinite(pose[8]) AND isfinite(pose[12]) AS known
  FROM joined WHERE role = 'target' AND stream = 'state' AND np = 16 AND nj = 6"""
CTES["ser0"] = SERIES
CTES["ser"] = "SELECT *, CASE WHEN known THEN sqrt((rx - dx)**2 + (ry - dy)**2 + (rz - dz)**2) END AS res FROM ser0"
BROKEN = (
    "lost_file", "wrong_size", "wrong_digest", "changed_source", "foreign_uri", "extra_message", "miscounted_topic",
    "unclassified", "offset_mismatch", "decode_error", "missing_topic",
)
VARIANT = "unnest(CASE WHEN {ep} % 5 <> 4 THEN [{names}] ELSE ['all'] END) AS variant"


def variants(names: tuple[str, ...], ep: str) -> str:
    return VARIANT.format(ep=ep, names=", ".join(f"'{n}'" for n in names))


def checks(pairs: dict[str, str], source: str, keep: str = "variant") -> str:
    return " UNION ALL ".join(f"SELECT {keep}, '{name}' AS name, {text} AS passed FROM {source}" for name, text in pairs.items())


def integrity(variant: str, side: str, moved: str) -> str:
    """Key integrity of one variant, by comparing grouped keys."""
    return f"""SELECT 'fx://frames/events.parquet' AS source_uri, count(*) FILTER (n1 > 0)::BIGINT AS source_rows, coalesce(sum(n2), 0)::BIGINT AS sidecar_rows,
  count(*) FILTER (n2 > 1) AS duplicate_keys, count(*) FILTER (n1 = 0) AS orphan_keys, count(*) FILTER (n2 = 0) AS missing_keys,
  count(*) FILTER (n1 > 0 AND n2 > 0 AND fi <> fj) AS reordered_keys, '{variant}' AS variant
  FROM (SELECT coalesce(s.source_row, k.source_row) AS row, count(DISTINCT s.source_row) AS n1, count(k.source_row) AS n2, min(s.fi) AS fi, min(k.fi) AS fj
    FROM (SELECT source_row, source_row AS fi FROM frm) s FULL JOIN ({side}) k USING (source_row) GROUP BY 1)"""


FRAIL = """SELECT topic, (pose_status = 'intact')::INT AS pi, (joint_status = 'intact')::INT AS ji,
  (joint_status = 'intact' AND NOT (position[1] > 0.9 OR position[2] > 1.2))::INT AS fv FROM tgt"""


ORACLE_SQL: dict[str, str] = {
    "topic_counts_ignored": sql("SELECT role, topic, arm, stream, count(*) AS n FROM msg GROUP BY ALL"),
    "pose_class_by_topic": sql("SELECT topic, pose_status, count(*) AS n FROM tgt GROUP BY ALL"),
    "joint_class_by_topic": sql("SELECT topic, joint_status, count(*) AS n FROM tgt GROUP BY ALL"),
    "residuals_by_topic": sql(
        f"SELECT topic, count(tm) AS compared, count(*) FILTER (outside) AS outside, {cols(RESIDUALS)} FROM scored WHERE role = 'target' GROUP BY topic"
    ),
    "base_offset_stats": sql(
        f"SELECT source_uri, t.topic, {rcols(OFFSETS)} FROM (SELECT * FROM sources CROSS JOIN tdim) t LEFT JOIN"
        " (SELECT * FROM scored WHERE role = 'target') c USING (source_uri, topic) GROUP BY ALL"
    ),
    "offset_merge_from_topics": sql(f"SELECT source_uri, offset_count, {', '.join(f'{r(n)} AS {n}' for n in OFFSETS if n != 'offset_count')} FROM right_"),
    "offset_merge_by_arm": sql(f"SELECT arm, {rcols(OFFSETS)}, {cols(RESIDUALS)} FROM scored WHERE role = 'target' GROUP BY arm"),
    "rig_cohorts": sql("SELECT cohort_x, cohort_y, cohort_z, count(*) AS files, sum(offset_count)::BIGINT AS pose_records FROM cohort GROUP BY ALL"),
    "rig_cohort_tasks": sql(
        "SELECT cohort_x, cohort_y, cohort_z, task, count(*) AS files FROM cohort JOIN eps USING (source_uri) WHERE offset_count > 0 GROUP BY ALL"
    ),
    "file_audit_verdict": sql("SELECT * FROM files"),
    "batch_totals": sql(
        "SELECT count(*) AS files, " + ", ".join(f"sum({n})::BIGINT AS {n}" for n in (
            "messages", "ignored_messages", "invalid_pose", "intact_pose", "recoverable_invalid_pose", "unrecoverable_invalid_pose",
            "fk_compared", "fk_outside_tolerance", "decode_errors")) + ", bool_and(passed) AS passed FROM files"
    ),
    "corpus_rollup": sql(
        f"SELECT t.topic, {cols(COUNTS)}, {cols(RESIDUALS)},"
        " count(DISTINCT source_uri) FILTER (sequence IS NULL) AS missing_topic_occurrences"
        " FROM (SELECT * FROM sources CROSS JOIN tdim) t LEFT JOIN (SELECT * FROM scored WHERE role = 'target') c USING (source_uri, topic)"
        " GROUP BY ROLLUP (t.topic)"
    ),
    "corpus_totals": sql(
        "SELECT count(*) AS files, sum(size)::BIGINT AS bytes, sum(n_events)::BIGINT AS declared_all_messages,"
        " sum(all_messages)::BIGINT AS summary_all_messages, sum(plot_messages)::BIGINT AS plot_messages, "
        + ", ".join(f"sum({n})::BIGINT AS {n}" for n in COUNTS)
        + ", sum(decode_errors)::BIGINT AS decode_errors, sum(missing_topic_count)::BIGINT AS missing_topic_occurrences,"
        " sum(issue_count)::BIGINT AS issues FROM files JOIN eps USING (source_uri) JOIN summ USING (source_uri, ep)"
    ),
    "conclusion_facts": sql(
        f"SELECT sum(missing_pose) > 0 AS missing_poses_exist, sum(malformed_pose) > 0 AS malformed_poses_exist, sum(nonfinite_pose) > 0 AS nonfinite_poses_exist,"
        f" sum(invalid_pose) > 0 AS invalid_poses_exist, count(*) FILTER (invalid_pose > 0) AS episodes_with_invalid_poses,"
        f" count(*) FILTER (invalid_pose = messages) AS episodes_all_invalid, {r('sum(missing_pose) / sum(messages)')} AS missing_pose_fraction,"
        " sum(recoverable_invalid_pose)::BIGINT AS recoverable_invalid_pose, sum(unrecoverable_invalid_pose)::BIGINT AS unrecoverable_invalid_pose,"
        " count(*) FILTER (fk_outside_tolerance > 0) AS episodes_outside_tolerance,"
        " (SELECT count(DISTINCT (cohort_x, cohort_y, cohort_z)) FROM cohort WHERE offset_count > 0) AS observed_cohorts,"
        " (SELECT count(DISTINCT (cohort_x, cohort_y, cohort_z)) FROM cohort WHERE offset_count > 0) > 1 AS several_base_offsets FROM files"
    ),
    "issue_sample": sql(
        """SELECT source_uri, topic, log_time_ns, sequence, code, detail, issue_count, issue_count > 7 AS truncated FROM (
  SELECT i.*, row_number() OVER (PARTITION BY source_uri ORDER BY scan_time, scan_topic, sequence, code_order) AS k FROM issue i) JOIN files USING (source_uri) WHERE k <= 7""",
        issue="""SELECT source_uri, '<decoder>' AS topic, NULL::BIGINT AS log_time_ns, sequence, 'decode_error' AS code, 'payload: payload' AS detail, log_time_ns AS scan_time, topic AS scan_topic, 0 AS code_order FROM scored WHERE role = 'decode_error'
UNION ALL SELECT source_uri, topic, log_time_ns, sequence, pose_status || '_pose', CASE WHEN pose IS NULL THEN 'pose is absent' WHEN np = 0 THEN 'pose is empty'
  WHEN np <> 16 THEN 'pose length ' || np || ', need 16' WHEN fp <> 16 THEN 'pose holds NaN or infinity' WHEN abs(m[13]) > 1e-5 THEN 'bottom row is not (0, 0, 0, 1)'
  WHEN abs(m[1]*m[1] + m[5]*m[5] + m[9]*m[9] - 1) > 1e-4 THEN 'rotation is not orthonormal' ELSE 'rotation determinant is not +1' END, log_time_ns, topic, 2 FROM scored WHERE role = 'target' AND pose_status <> 'intact'
UNION ALL SELECT source_uri, topic, log_time_ns, sequence, joint_status || '_joints', CASE WHEN position IS NULL THEN 'position is absent' WHEN nj = 0 THEN 'position is empty'
  WHEN nj <> 6 THEN 'position length ' || nj || ', need 6' ELSE 'position holds NaN or infinity' END, log_time_ns, topic, 3 FROM scored WHERE role = 'target' AND joint_status <> 'intact'
UNION ALL SELECT source_uri, topic, log_time_ns, sequence, 'fk_residual_outside_tolerance', NULL, log_time_ns, topic, 5 FROM scored WHERE outside""",
    ),
    "missing_topics": sql(
        "SELECT s.source_uri, t.topic, t.topic_order::BIGINT AS topic_order FROM sources s CROSS JOIN tdim t WHERE NOT EXISTS"
        " (SELECT 1 FROM msg WHERE msg.source_uri = s.source_uri AND msg.topic = t.topic AND role = 'target')"
    ),
    "decode_error_counts": sql(
        "SELECT 'clean' AS variant, source_uri, count(*) FILTER (role = 'decode_error') AS decode_errors, 0::BIGINT AS record_errors FROM msg GROUP BY source_uri"
        " UNION ALL SELECT 'lost_topics', source_uri, count(*) FILTER (role = 'decode_error'),"
        " count(*) FILTER (role <> 'decode_error' AND sequence % 89 = 0) FROM msg GROUP BY source_uri"
    ),
    "fk_pose_arm_local": sql(f"SELECT source_uri, sequence, {', '.join(f'{r(n)} AS {n}' for n in POSE7)} FROM rec WHERE fk_status = 'derived'"),
    "pose_roundtrip_matrix": sql(
        "SELECT sequence, " + ", ".join(f"{r(matrix_entries()[i][j])} AS r{i}{j}" for i in range(3) for j in range(3))
        + " FROM rec WHERE fk_status = 'derived'"
    ),
    "joint_limit_violations": sql(
        " UNION ALL ".join(
            f"SELECT topic, count(*) AS rows, {j + 1}::BIGINT AS joint, count(*) FILTER (position[{j + 1}] < {low} OR position[{j + 1}] > {high}) AS outside"
            " FROM tgt WHERE joint_status = 'intact' GROUP BY topic" for j, (low, high) in enumerate(LIMITS)
        )
    ),
    "cohort_corrected_residuals": sql(
        f"SELECT topic, count(ct) AS compared, {r('avg(ct)')} AS mean, {r('sqrt(avg(ct*ct))')} AS rmse, {r('max(ct)')} AS max, count(*) FILTER (ct > 1e-5) AS outside FROM fixed GROUP BY topic",
        fixed="SELECT topic, CASE WHEN arm = 'right' THEN sqrt((ox - offset_mean_x)**2 + (oy - offset_mean_y)**2 + (oz - offset_mean_z)**2)"
        " ELSE sqrt(ox*ox + oy*oy + oz*oz) END AS ct FROM scored JOIN right_ USING (source_uri) WHERE cmp",
    ),
    "shared_frame_or_refusal": sql(
        "SELECT source_uri, sequence, arm, "
        + ", ".join(
            f"CASE WHEN fk_status = 'derived' AND offset_count > 0 THEN {r(f'{a} + CASE WHEN arm = ' + chr(39) + 'right' + chr(39) + f' THEN cohort_{a} ELSE 0 END')} END AS shared_{a}"
            for a in "xyz"
        )
        + ", CASE WHEN fk_status <> 'derived' THEN 'no_arm_local_pose' WHEN offset_count = 0 THEN 'cohort_unobserved' END AS refusal"
        " FROM rec JOIN cohort USING (source_uri)"
    ),
    "recovery_rows": sql(
        f"""SELECT source_uri, (SELECT lfs_oid FROM eps WHERE eps.ep = rec.ep) AS source_sha256, regexp_extract(path, '(task_\\d+)', 1) AS task,
  CASE WHEN ep % 2 = 0 THEN 'episode_s' || {TWO} ELSE 'episode_' || {TWO} END AS episode, topic, log_time_ns, publish_time_ns, sequence,
  row_number() OVER (PARTITION BY source_uri ORDER BY log_time_ns, topic, sequence) - 1 AS message_ordinal, arm, stream, pose_status, joint_status,
  fk_status, recovery_status, status_mask, pose_status <> 'intact' AND fk_status = 'derived' AS recovered, """
        + ", ".join(f"CASE WHEN fk_status = 'derived' THEN {r(n)} END AS {n}" for n in POSE7)
        + " FROM rec"
    ),
    "recovery_status_hist": sql(
        "SELECT field, status, source_uri, count(*) AS n FROM long GROUP BY GROUPING SETS ((field, status, source_uri), (field, status))",
        long=" UNION ALL ".join(f"SELECT source_uri, '{f}' AS field, {f} AS status FROM rec" for f in ("pose_status", "joint_status", "fk_status", "recovery_status")),
    ),
    "quarantine": sql(
        "SELECT source_uri, topic, log_time_ns, sequence, recovery_status AS reason,"
        " 'pose ' || pose_status || ', joints ' || joint_status || ', fk ' || fk_status AS evidence FROM rec WHERE recovery_status LIKE 'unrecoverable%'"
    ),
    "accounting_three_way": sql(
        "SELECT source_uri, topic, coalesce(total, 0) AS total, coalesce(observed_valid, 0) AS observed_valid, coalesce(derived_valid, 0) AS derived_valid,"
        " coalesce(refused, 0) AS refused, coalesce(n, 0) AS declared, coalesce(total, 0) = coalesce(n, 0) AS reconciles FROM acc FULL JOIN"
        f" (SELECT source_uri, topic, n FROM chan WHERE topic IN ({TOPIC_LIST})) USING (source_uri, topic)",
        acc=f"SELECT source_uri, topic, count(*) AS total, count(*) FILTER ({CLASS} = 'o') AS observed_valid, count(*) FILTER ({CLASS} = 'd') AS derived_valid,"
        f" count(*) FILTER ({CLASS} = 'f') AS refused FROM rec GROUP BY ALL",
    ),
    "audit_matrix": sql(
        "SELECT source_uri, "
        + ", ".join(
            f"{r(f'avg(CASE WHEN {CLASS} = {chr(39)}f{chr(39)} THEN 0.0 ELSE 1.0 END) FILTER (topic = {chr(39)}{t}{chr(39)})')} AS coverage_{t[1:].replace('-arm-', '_')}"
            for t in TOPICS
        )
        + " FROM rec GROUP BY source_uri"
    ),
    "envelope_range_violations": sql(
        "SELECT 'clean' AS variant, source_uri, count(*) AS rows, 0::BIGINT AS bad_log_time_ns, 0::BIGINT AS bad_publish_time_ns, 0::BIGINT AS bad_sequence FROM tgt GROUP BY source_uri"
        " UNION ALL SELECT 'broken', source_uri, count(*), count(*) FILTER (sequence % 70 = 0), count(*) FILTER (sequence % 50 = 0), count(*) FILTER (sequence % 30 = 0) FROM tgt GROUP BY source_uri"
    ),
    "episode_resolution": sql(
        f"""SELECT source_uri, task, CASE WHEN ep % 2 = 0 THEN 'episode_s' || {TWO} ELSE episode_id END AS episode,
  CASE WHEN ep % 2 = 0 THEN 'session' ELSE 'path' END AS episode_from, false AS conflict, false AS blank_identity, 'clean' AS variant FROM eps
UNION ALL SELECT source_uri, task, CASE WHEN ep % 8 = 0 THEN 'given' WHEN ep = 2 THEN 'episode_other' WHEN ep % 2 = 0 THEN 'episode_s' || {TWO} ELSE episode_id END,
  CASE WHEN ep % 8 = 0 THEN 'supplied' WHEN ep % 2 = 0 THEN 'session' ELSE 'path' END, ep = 2, ep % 8 = 3, 'broken' FROM eps"""
    ),
    "release_selection": sql("SELECT * FROM releases"),
    "release_gate": sql(
        " UNION ALL ".join(
            f"SELECT '{v}' AS variant, 'release_has_no_refused_file' AS gate, count(*) FILTER (decision = 'refused') = 0 AS passed FROM releases {w}"
            f" UNION ALL SELECT '{v}', 'release_selects_a_file', count(*) FILTER (decision = 'selected') > 0 FROM releases {w}"
            for v, w in (("all", ""), ("clean", "WHERE clean"))
        )
    ),
    "release_rows": sql(
        "SELECT source_uri, recovery_status, count(*) AS n, max(status_mask) AS status_mask FROM rec WHERE source_uri IN"
        " (SELECT source_uri FROM releases WHERE clean AND decision = 'selected') GROUP BY ALL"
    ),
    "stride_series": sql(
        f"SELECT source_uri, arm, ordinal, sequence, log_time_ns, "
        + ", ".join(f"CASE WHEN known THEN {r(p + a)} END AS {n}_{a}" for n, p in (("rec", "r"), ("der", "d")) for a in "xyz")
        + f", {r('res')} AS residual_m FROM (SELECT *, row_number() OVER (PARTITION BY source_uri, arm ORDER BY log_time_ns, topic, sequence) - 1 AS ordinal FROM ser) WHERE ordinal % 20 = 0"
    ),
    "series_summary": sql(
        f"SELECT source_uri, arm, count(*) AS source_records, (count(*) + 19) // 20 AS sampled_records, {r('max(res)')} AS max_residual_m FROM ser GROUP BY ALL"
    ),
    "residual_quantiles": sql(
        "SELECT topic, probability::DOUBLE AS probability, min(value) AS value, any_value(total) AS total FROM ranked,"
        " (SELECT unnest([0.5, 0.9, 0.95, 0.99, 1.0]) AS probability) WHERE k >= greatest(1, ceil(probability * total)) GROUP BY topic, probability",
        ranked=f"SELECT topic, {r('tm')} AS value, row_number() OVER (PARTITION BY topic ORDER BY {r('tm')}) AS k, count(*) OVER (PARTITION BY topic) AS total FROM scored WHERE cmp",
    ),
    "residual_sketches": sql(
        "SELECT level, name, probability::DOUBLE AS probability, total, true AS within_bound FROM ("
        "SELECT 'topic' AS level, topic AS name, count(*) AS total FROM scored WHERE cmp GROUP BY topic"
        " UNION ALL SELECT 'file', source_uri, count(*) FROM scored WHERE cmp GROUP BY source_uri"
        " UNION ALL SELECT 'corpus', 'all', count(*) FROM scored WHERE cmp), (SELECT unnest([0.05, 0.25, 0.5, 0.9, 0.99]) AS probability)"
    ),
    "incremental_topic_audit": sql(
        f"SELECT source_uri, t.topic, {cols(COUNTS)}, {cols(RESIDUALS)}, {rcols(OFFSETS)}, any_value(i.ignored) AS source_ignored,"
        " any_value(i.broken) AS source_decode_errors FROM (SELECT * FROM sources CROSS JOIN tdim) t LEFT JOIN"
        " (SELECT * FROM scored WHERE role = 'target') c USING (source_uri, topic) JOIN (SELECT source_uri,"
        " count(*) FILTER (role = 'ignored') AS ignored, count(*) FILTER (role = 'decode_error') AS broken FROM msg GROUP BY source_uri) i USING (source_uri)"
        " GROUP BY source_uri, t.topic"
    ),
    "worst_residuals": sql(
        f"SELECT source_uri, topic, sequence, residual FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY residual DESC, source_uri, sequence) AS k"
        f" FROM (SELECT source_uri, topic, sequence, {r('tm')} AS residual FROM scored WHERE cmp)) WHERE k <= 5"
    ),
    "frame_masks": sql("SELECT 'fx://frames/events.parquet' AS source_uri, source_row, valid_mask, invalid_input_mask FROM masks"),
    "frame_mask_bit_counts": sql(
        " UNION ALL ".join(
            f"SELECT '{n}' AS limb, count(*) FILTER (ok{i}) AS valid, count(*) FILTER (NOT ok{i}) AS invalid_input, 0::BIGINT AS derivation_failure FROM masks"
            for i, n in enumerate(("observation.left_arm", "observation.right_arm", "action.left_arm", "action.right_arm"))
        )
    ),
    "frame_sidecar_poses": sql(
        f"SELECT 'fx://frames/events.parquet' AS source_uri, source_row, episode_index, source_row AS frame_index, source_row AS index, timestamp, "
        + ", ".join(f"CASE WHEN ok{i} THEN {r(f'fkl{i}.{p}')} END AS {n}_{p}" for i, (n, *_r) in enumerate(LIMBS) for p in POSE7)
        + ", valid_mask, invalid_input_mask, 0::BIGINT AS derivation_failure_mask FROM masks "
        + " ".join(f"JOIN fkl{i} ON fkl{i}.vec_id = masks.vec_id" for i in range(4))
    ),
    "sidecar_key_integrity": sql(
        integrity("clean", "SELECT source_row, source_row AS fi FROM frm", "")
        + " UNION ALL "
        + integrity(
            "broken",
            "SELECT CASE WHEN source_row % 109 = 0 THEN -source_row - 1 ELSE source_row END AS source_row, source_row + CASE WHEN source_row % 107 = 0 THEN 1 ELSE 0 END AS fi"
            " FROM (SELECT source_row, unnest(range(CASE WHEN source_row % 103 = 0 THEN 2 ELSE 1 END)) AS c FROM frm WHERE source_row % 101 <> 0)",
            "",
        )
    ),
    "frame_key_violations": sql(
        "SELECT 'fx://frames/events.parquet' AS source_uri, 'clean' AS variant, count(*) AS rows, 0::BIGINT AS null_episode_index, 0::BIGINT AS null_frame_index, 0::BIGINT AS null_index, 0::BIGINT AS bad_timestamp FROM frm"
        " UNION ALL SELECT 'fx://frames/events.parquet', 'broken', count(*), count(*) FILTER (source_row % 41 = 0), 0, count(*) FILTER (source_row % 43 = 0),"
        " count(*) FILTER (source_row % 47 = 0 OR source_row % 53 = 0 OR source_row % 59 = 0) FROM frm"
    ),
    "inventory_samples_join": sql(
        """SELECT path, 1::BIGINT AS n_inventory, 1::BIGINT AS n_samples, true AS path_ok, 'matched' AS status, 'clean' AS variant FROM eps
UNION ALL SELECT path, CASE WHEN ep = 2 THEN 2 ELSE 1 END, CASE WHEN ep IN (1, 4) THEN 0 ELSE 1 END, true,
  CASE ep WHEN 2 THEN 'duplicate_inventory' WHEN 1 THEN 'no_sample' WHEN 4 THEN 'no_sample' WHEN 3 THEN 'inconsistent' ELSE 'matched' END, 'broken' FROM eps
UNION ALL SELECT 'data/val/task_99/episode_99/other.mcap', 0, 1, false, 'not_in_inventory', 'broken' FROM eps WHERE ep = 4"""
    ),
    "inventory_fingerprint": sql(
        """SELECT count(*) AS entries, sha256('[' || string_agg('{"lfs":{"oid":"' || lfs_oid || '","size":' || size || '},"oid":"' ||
  oid || '","path":"' || path || '","size":' || size || '}', ',' ORDER BY path) || ']') AS fingerprint FROM eps"""
    ),
    "inventory_file_identity": sql("SELECT path, ep NOT IN (7, 9) AS size_matches, ep NOT IN (6, 9) AS sha256_matches FROM eps"),
    "inventory_gates": sql(
        "SELECT 'clean' AS variant, count(*) AS entries, count(DISTINCT path) AS paths, 0::BIGINT AS duplicate_paths, 0::BIGINT AS refused_entries FROM eps"
        " UNION ALL SELECT 'broken', count(*), count(*) - count(*) FILTER (ep = 2), count(*) FILTER (ep = 2), count(*) FILTER (ep IN (1, 5, 6)) FROM eps"
    ),
    "source_identity": sql(
        "SELECT source_uri, size AS size_bytes, CASE WHEN ep IN (3, 7) THEN 'mismatch' WHEN ep % 4 = 0 THEN 'not_supplied' ELSE 'verified' END AS status FROM eps"
    ),
    "source_deduplication": sql("SELECT path, (1 + CASE WHEN ep % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN ep = 6 THEN 1 ELSE 0 END)::BIGINT AS copies, ep = 6 AS conflict FROM eps"),
    "canonical_uris": sql(
        "SELECT path, 'hf://datasets/lab/arm-telemetry@rev-1/' || path AS uri, 'https://files.example.org/datasets/lab/arm-telemetry/resolve/rev-1/' || path AS url,"
        f" CASE WHEN ep = 3 THEN 'other_task' ELSE task END AS task, CASE WHEN ep % 4 = 0 THEN {TWO} ELSE episode_id END AS episode, ep <> 3 AS consistent FROM eps"
    ),
    "channel_summary_reconcile": sql(
        " UNION ALL ".join(
            f"SELECT source_uri, topic, coalesce(t.decoded, 0) AS decoded, coalesce(c.n, 0)::BIGINT + {e} AS declared, coalesce(t.decoded, 0) = coalesce(c.n, 0) + {e} AS matches,"
            f" s.all_messages + CASE WHEN s.ep = 1 THEN {k} ELSE 0 END AS all_messages, s.plot_messages, '{v}' AS variant"
            " FROM (SELECT source_uri, topic FROM sources CROSS JOIN tdim) LEFT JOIN dec t USING (source_uri, topic) LEFT JOIN chan c USING (source_uri, topic) LEFT JOIN summ s USING (source_uri)"
            for v, e, k in (("clean", "0", 0), ("broken", "CASE WHEN s.ep = 1 AND topic = '/left-arm-state' THEN 1 ELSE 0 END", 1))
        ),
        dec="SELECT source_uri, topic, count(*) AS decoded FROM tgt GROUP BY ALL",
    ),
    "field_length_hist": sql(
        "SELECT source_uri, 'pose' AS field, np AS length, count(*) AS n, count(*) FILTER (np > fp) AS nonfinite FROM tgt GROUP BY ALL"
        " UNION ALL SELECT source_uri, 'position', nj, count(*), count(*) FILTER (nj > fj) FROM tgt GROUP BY ALL"
    ),
    "field_length_hist_corpus": sql(
        "SELECT 'pose' AS field, np AS length, count(*) AS n, count(*) FILTER (np > fp) AS nonfinite FROM tgt GROUP BY ALL"
        " UNION ALL SELECT 'position', nj, count(*), count(*) FILTER (nj > fj) FROM tgt GROUP BY ALL"
    ),
    "cross_check": sql(
        checks(
            {
                "all_source_hashes": "variant <> 'tampered'",
                "target_messages": "true",
                "missing_pose_records": "n0 = n_missing",
                "intact_length_pose_records": "n16 = n_intact",
                "only_expected_pose_lengths": "odd = 0",
                "six_joint_records": "not6 = 0",
                "nonfinite_pose_records": "badp = n_nonfinite",
                "nonfinite_joint_records": "badj = 0",
            },
            "facts",
        ),
        facts=f"SELECT variant, count(*) FILTER (np = 0) AS n0, count(*) FILTER (np = 16) AS n16, count(*) FILTER (np NOT IN (0, 16)) AS odd, count(*) FILTER (nj <> 6) AS not6,"
        " count(*) FILTER (np > fp) AS badp, count(*) FILTER (nj > fj) AS badj, count(*) FILTER (pose_status = 'missing') AS n_missing,"
        f" count(*) FILTER (pose_status = 'intact') AS n_intact, count(*) FILTER (pose_status = 'nonfinite') AS n_nonfinite FROM (SELECT *, {variants(('all', 'clean', 'tampered'), 'ep')} FROM tgt) GROUP BY variant",
    ),
    "invariants": sql(
        checks(
            {
                "expected_file_count": "n = (SELECT count(*) FROM eps WHERE ep % 5 <> 4) AND variant <> 'lost_file'",
                "sizes_match_inventory": "variant NOT IN ('wrong_size', 'lost_file')",
                "digests_match_inventory": "variant NOT IN ('wrong_digest', 'lost_file')",
                "sources_unchanged_by_audit": "variant NOT IN ('changed_source', 'lost_file')",
                "audit_sources_are_pinned_uris": "variant NOT IN ('foreign_uri', 'lost_file')",
                "declared_plus_plot_equals_summary": "variant <> 'extra_message'",
                "decoded_counts_match_summary": "errors_on_target = 0 AND variant <> 'miscounted_topic'",
                "pose_classification_is_exhaustive": "variant <> 'unclassified'",
                "offset_counts_match_compared": "variant <> 'offset_mismatch'",
                "no_decode_errors": "errors = 0 AND variant <> 'decode_error'",
                "no_missing_target_topics": "missing = 0 AND variant <> 'missing_topic'",
            },
            "facts",
        ),
        facts=f"SELECT variant, count(*) AS n, sum(decode_errors) AS errors, sum(missing_topic_count) AS missing, sum(hidden) AS errors_on_target FROM"
        f" (SELECT *, {variants(('all', 'clean', *BROKEN), 'ep')} FROM files JOIN eps USING (source_uri) JOIN hid USING (source_uri)) GROUP BY variant",
        hid=f"SELECT source_uri, count(*) FILTER (undecodable AND topic IN ({TOPIC_LIST})) AS hidden FROM placed GROUP BY source_uri",
    ),
    "publish_and_verify": sql("SELECT valid_mask, count(*) AS n, count(*) FILTER (ok3) AS right_action_poses FROM masks GROUP BY valid_mask"),
    "planted_canaries": sql(
        "SELECT pose_status = 'intact' AND pick < 3 AS planted, CASE WHEN pose_status <> 'intact' THEN pose_status ELSE CASE pick WHEN 0 THEN 'missing' WHEN 1 THEN 'malformed'"
        " WHEN 2 THEN 'nonfinite' ELSE 'intact' END END AS expected_class, count(*) AS rows, count(*) AS caught FROM picked GROUP BY ALL",
        picked="SELECT pose_status, ('0x' || substr(md5(concat_ws('|', source_uri, topic, log_time_ns, sequence)), 1, 8))::BIGINT % 50 AS pick FROM tgt",
    ),
    "content_digest_stable": sql("SELECT count(*) AS rows, true AS stable, true AS sees_a_change FROM tgt"),
    "content_fingerprints": """SELECT name, strlen(content)::BIGINT AS size_bytes, sha256(content) AS sha256,
  sha1(encode('blob ' || strlen(content)) || '\\x00'::BLOB || encode(content)) AS git_oid
  FROM (SELECT 'document ' || doc_id AS name, text AS content FROM documents UNION ALL SELECT 'page ' || page_id, html FROM pages)""",
    "reused_uris": sql("SELECT source_uri, 2::BIGINT AS paths FROM eps WHERE ep % 5 = 0 AND ep + 1 IN (SELECT ep FROM eps)"),
    "job_recovery": sql(
        f"""SELECT source_uri, CASE WHEN ep % 2 = 0 THEN 'episode_s' || {TWO} ELSE 'episode_' || {TWO} END AS episode, recovery_status, count(*) AS n,
  min(k) AS first_ordinal, max(k) AS last_ordinal, count(*) AS poses, NULL::VARCHAR AS gate
  FROM (SELECT *, row_number() OVER (PARTITION BY source_uri ORDER BY log_time_ns, topic, sequence) - 1 AS k FROM rec WHERE ep % 5 <> 4) GROUP BY ALL
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'expected_identity_holds'"""
    ),
    "job_recovery_in_place": sql(
        f"""SELECT source_uri, CASE WHEN ep % 2 = 0 THEN 'episode_s' || {TWO} ELSE 'episode_' || {TWO} END AS episode, count(*) AS n,
  0::BIGINT AS first_ordinal, count(*) - 1 AS last_ordinal, count(*) AS ordinals, true AS same_digest
  FROM rec WHERE ep % 5 <> 4 GROUP BY ALL"""
    ),
    "job_release": sql(
        """SELECT source_uri, recovery_status, count(*) AS n, NULL::VARCHAR AS gate FROM rec WHERE source_uri IN
  (SELECT source_uri FROM releases WHERE clean AND decision = 'selected') GROUP BY ALL
UNION ALL SELECT NULL, NULL, NULL, unnest(['rows_are_as_audited', 'release_has_no_refused_file'])"""
    ),
    "job_augmentation": sql(
        "SELECT valid_mask, count(*) AS n, count(*) AS frames, count(*) AS hashed, NULL::VARCHAR AS gate FROM masks GROUP BY valid_mask"
        " UNION ALL SELECT NULL, NULL, NULL, NULL, 'frame_keys_are_valid'"
    ),
    "job_corpus_audit": sql(
        """SELECT name, passed, NULL::BIGINT AS n, NULL::VARCHAR AS gate FROM (
  SELECT unnest(['expected_file_count', 'sizes_match_inventory', 'digests_match_inventory', 'sources_unchanged_by_audit', 'audit_sources_are_pinned_uris',
    'declared_plus_plot_equals_summary', 'pose_classification_is_exhaustive', 'offset_counts_match_compared', 'all_source_hashes', 'target_messages', 'missing_pose_records']) AS name, true AS passed
  UNION ALL SELECT 'decoded_counts_match_summary', hidden = 0 FROM by_file UNION ALL SELECT 'no_decode_errors', errors = 0 FROM by_file UNION ALL SELECT 'no_missing_target_topics', missing = 0 FROM by_file
  UNION ALL SELECT 'intact_length_pose_records', n16 = n_intact FROM by_field UNION ALL SELECT 'only_expected_pose_lengths', odd = 0 FROM by_field UNION ALL SELECT 'six_joint_records', not6 = 0 FROM by_field
  UNION ALL SELECT 'nonfinite_pose_records', badp = n_nonfinite FROM by_field UNION ALL SELECT 'nonfinite_joint_records', badj = 0 FROM by_field
  UNION ALL SELECT 'integrity_passed', hidden = 0 AND errors = 0 AND missing = 0 FROM by_file
  UNION ALL SELECT 'reconciled', n16 = n_intact AND odd = 0 AND not6 = 0 AND badp = n_nonfinite AND badj = 0 FROM by_field
  UNION ALL SELECT 'passed', hidden = 0 AND errors = 0 AND missing = 0 AND ok FROM by_file)
UNION ALL SELECT unnest(['files', 'bytes', 'messages', 'issues']), NULL, unnest([n, bytes, messages, issues]), NULL FROM by_file
UNION ALL SELECT NULL, NULL, NULL, 'inventory_fingerprint_is_pinned'""",
        by_file=f"SELECT count(*) AS n, sum(size)::BIGINT AS bytes, sum(messages)::BIGINT AS messages, sum(issue_count)::BIGINT AS issues, sum(decode_errors) AS errors,"
        f" sum(missing_topic_count) AS missing, sum(hidden) AS hidden, bool_and(passed) AS ok FROM files JOIN eps USING (source_uri) JOIN hid USING (source_uri)",
        hid=f"SELECT source_uri, count(*) FILTER (undecodable AND topic IN ({TOPIC_LIST})) AS hidden FROM placed GROUP BY source_uri",
        by_field="SELECT count(*) FILTER (np = 16) AS n16, count(*) FILTER (np NOT IN (0, 16)) AS odd, count(*) FILTER (nj <> 6) AS not6, count(*) FILTER (np > fp) AS badp,"
        " count(*) FILTER (nj > fj) AS badj, count(*) FILTER (pose_status = 'intact') AS n_intact, count(*) FILTER (pose_status = 'nonfinite') AS n_nonfinite FROM tgt",
    ),
    "inventory_tree_digest": sql(
        """SELECT sum(n)::BIGINT AS entries, CASE WHEN count(*) = 1 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY number)) END AS digest FROM leaves""",
        leaves="SELECT number // 64 AS number, count(*) AS n, sha256(string_agg(digest, '' ORDER BY number)) AS digest FROM entry GROUP BY 1",
        entry="""SELECT row_number() OVER (ORDER BY path) - 1 AS number, sha256('{"lfs":{"oid":"' || lfs_oid || '","size":' || size || '},"oid":"' ||
  oid || '","path":"' || path || '","size":' || size || '}') AS digest FROM eps""",
    ),
    "audit_matrix_by_cohort": sql(
        " UNION ALL ".join(
            f"SELECT cohort_x, cohort_y, cohort_z, topic, '{field}' AS field, count(*) AS n, {r(f'count(*) FILTER ({text}) / count(*)')} AS share"
            " FROM rec JOIN cohort USING (source_uri) GROUP BY ALL"
            for field, text in (("recorded_pose", "pose_status = 'intact'"), ("joints", "joint_status = 'intact'"), ("pose", f"{CLASS} <> 'f'"))
        )
    ),
    "fk_failure_statuses": sql(
        "SELECT topic, recovery_status, fk_status, (pi + ji * 2 + fv * 4 + (1 - pi) * fv * 8)::BIGINT AS status_mask, count(*) AS n FROM frail GROUP BY ALL",
        frail="""SELECT topic, pi, ji, fv, CASE WHEN ji = 0 THEN 'not_attempted_invalid_joints' WHEN fv = 1 THEN 'derived' ELSE 'failure' END AS fk_status,
  CASE WHEN fv = 1 THEN CASE WHEN pi = 1 THEN 'source_pose_intact' ELSE 'recovered' END WHEN ji = 1 THEN CASE WHEN pi = 1 THEN 'source_pose_intact_fk_failure' ELSE 'unrecoverable_fk_failure' END
    ELSE CASE WHEN pi = 1 THEN 'source_pose_intact_invalid_joints' ELSE 'unrecoverable_invalid_joints' END END AS recovery_status FROM frail0""",
        frail0=FRAIL,
    ),
    "fk_failure_audit": sql(
        "SELECT topic, count(*) AS messages, count(*) FILTER (ji = 1 AND fv = 0) AS fk_failures, count(*) FILTER (fv = 1 AND pi = 1) AS fk_compared,"
        " count(*) FILTER (pi = 0 AND fv = 1) AS recoverable_invalid_pose, count(*) FILTER (pi = 0 AND fv = 0) AS unrecoverable_invalid_pose FROM frail0 GROUP BY topic",
        frail0=FRAIL,
    ),
    "frame_failure_masks": sql(
        f"SELECT ({' + '.join(f'CASE WHEN ok{i} AND NOT bad{i} THEN {1 << i} ELSE 0 END' for i in range(4))})::BIGINT AS valid_mask,"
        f" ({' + '.join(f'CASE WHEN ok{i} THEN 0 ELSE {1 << i} END' for i in range(4))})::BIGINT AS invalid_input_mask,"
        f" ({' + '.join(f'CASE WHEN ok{i} AND bad{i} THEN {1 << i} ELSE 0 END' for i in range(4))})::BIGINT AS derivation_failure_mask, count(*) AS n FROM frail GROUP BY ALL",
        frail="SELECT *, " + ", ".join(f"{v}[{s}] > 0.9 OR {v}[{s + 1}] > 1.2 AS bad{i}" for i, (_, v, s, _f) in enumerate(LIMBS)) + " FROM ok",
    ),
    "joint_limit_refusal": sql(
        "SELECT topic, js AS joint_status, CASE WHEN js = 'intact' THEN CASE WHEN pose_status = 'intact' THEN 'source_pose_intact' ELSE 'recovered' END"
        " WHEN pose_status = 'intact' THEN 'source_pose_intact_invalid_joints' ELSE 'unrecoverable_invalid_joints' END AS recovery_status, count(*) AS n FROM held GROUP BY ALL",
        held="SELECT topic, pose_status, CASE WHEN joint_status = 'intact' AND NOT ("
        + " AND ".join(f"position[{j + 1}] BETWEEN {low} AND {high}" for j, (low, high) in enumerate(LIMITS))
        + ") THEN 'malformed' ELSE joint_status END AS js FROM tgt",
    ),
}
ORACLE_SQL["sidecar_integrity_by_difference"] = ORACLE_SQL["sidecar_key_integrity"]
ORACLE_SQL["job_audit_from_json"] = sql(
    """SELECT name, CASE WHEN v.variant = 'changed' AND name IN ('sources_unchanged_by_audit', 'integrity_passed', 'passed') THEN false ELSE passed END AS passed,
  v.variant, NULL::VARCHAR AS gate FROM (
  SELECT 'expected_file_count' AS name, n = (SELECT count(*) FROM eps) AS passed FROM by_file
  UNION ALL SELECT unnest(['sizes_match_inventory', 'digests_match_inventory', 'all_source_hashes']), lfs = total FROM by_ep
  UNION ALL SELECT 'sources_unchanged_by_audit', true
  UNION ALL SELECT 'audit_sources_are_pinned_uris', pinned = n FROM by_file
  UNION ALL SELECT 'declared_plus_plot_equals_summary', sums FROM by_ep
  UNION ALL SELECT 'decoded_counts_match_summary', hidden = 0 FROM by_file UNION ALL SELECT 'pose_classification_is_exhaustive', exhaustive FROM by_file
  UNION ALL SELECT 'offset_counts_match_compared', compared = offsets FROM by_field
  UNION ALL SELECT 'no_decode_errors', errors = 0 FROM by_file UNION ALL SELECT 'no_missing_target_topics', missing = 0 FROM by_file
  UNION ALL SELECT 'target_messages', rows = messages FROM by_field, by_file UNION ALL SELECT 'missing_pose_records', n0 = missing_pose FROM by_field, by_file
  UNION ALL SELECT 'intact_length_pose_records', n16 = n_intact FROM by_field UNION ALL SELECT 'only_expected_pose_lengths', odd = 0 FROM by_field UNION ALL SELECT 'six_joint_records', not6 = 0 FROM by_field
  UNION ALL SELECT 'nonfinite_pose_records', badp = n_nonfinite FROM by_field UNION ALL SELECT 'nonfinite_joint_records', badj = 0 FROM by_field
  UNION ALL SELECT 'integrity_passed', hidden = 0 AND errors = 0 AND missing = 0 AND exhaustive FROM by_file
  UNION ALL SELECT 'passed', hidden = 0 AND errors = 0 AND missing = 0 AND exhaustive AND ok FROM by_file), (SELECT unnest(['clean', 'changed']) AS variant) v
UNION ALL SELECT NULL, NULL, NULL, unnest(['inventory_entries_are_well_formed', 'translation tolerance must be finite and non-negative'])""",
    by_file="SELECT count(*) AS n, sum(messages)::BIGINT AS messages, sum(missing_pose) AS missing_pose, sum(decode_errors) AS errors, sum(missing_topic_count) AS missing,"
    " sum(hidden) AS hidden, bool_and(passed) AS ok, bool_and(missing_pose + malformed_pose + nonfinite_pose + intact_pose = messages) AS exhaustive,"
    " count(*) FILTER (starts_with(source_uri, 'fx://data/val/')) AS pinned FROM files JOIN eps USING (source_uri) JOIN hid USING (source_uri)",
    by_ep="SELECT count(*) AS total, count(*) FILTER (length(lfs_oid) = 64 AND size >= 1) AS lfs, bool_and(n_events + plot_messages = all_messages) AS sums FROM eps JOIN summ USING (source_uri, ep)",
    hid=f"SELECT source_uri, count(*) FILTER (undecodable AND topic IN ({TOPIC_LIST})) AS hidden FROM placed GROUP BY source_uri",
    by_field="SELECT count(*) AS rows, count(*) FILTER (np = 0) AS n0, count(*) FILTER (np = 16) AS n16, count(*) FILTER (np NOT IN (0, 16)) AS odd, count(*) FILTER (nj <> 6) AS not6,"
    " count(*) FILTER (np > fp) AS badp, count(*) FILTER (nj > fj) AS badj, count(*) FILTER (pose_status = 'intact') AS n_intact, count(*) FILTER (pose_status = 'nonfinite') AS n_nonfinite,"
    " count(tm) AS compared, count(ox) FILTER (cmp) AS offsets FROM scored WHERE role = 'target'",
)
ORACLE_SQL["job_recovery_from_lists"] = sql(
    "SELECT source_uri, 'verified' AS identity_status, CASE WHEN (row_number() OVER (ORDER BY source_uri) - 1) % 2 = 1 THEN 'supplied' ELSE 'path' END AS episode_from,"
    " n, NULL::VARCHAR AS gate FROM (SELECT source_uri, count(tgt.topic) AS n FROM eps LEFT JOIN tgt USING (source_uri) WHERE eps.ep % 5 <> 4 GROUP BY source_uri)"
    " UNION ALL SELECT NULL, NULL, NULL, NULL, 'sha256'"
)
ORACLE_SQL["job_augmentation_from_dataset"] = sql(
    "SELECT valid_mask, count(*) AS n, 'verified_info_json' AS contract, true AS described, NULL::VARCHAR AS gate FROM masks GROUP BY valid_mask"
    " UNION ALL SELECT NULL, NULL, NULL, NULL, unnest(['feature contract differs', 'missing required columns', 'observation.state must hold numbers'])"
)
ORACLE_SQL["frame_faults_by_file"] = sql(
    "SELECT CASE WHEN source_row % 8 = 5 THEN 'missing required columns: action' WHEN source_row % 8 = 6 THEN 'action must hold numbers'"
    " WHEN source_row % 8 = 7 THEN 'index must be an integer, found double' END AS fault, count(*) AS rows FROM frm GROUP BY fault"
)
ORACLE_SQL["tangled_identities"] = sql(
    """SELECT identity_group, count(*) AS rows, count(DISTINCT path) AS paths, count(DISTINCT source_uri) AS source_uris, count(DISTINCT sha256) AS sha256s
FROM (SELECT path, source_uri, sha256, (SELECT min(least(b.p, b.u, b.s)) FROM reach r JOIN named b ON b.ep = r.b WHERE r.a = n.ep) AS identity_group FROM named n
  WHERE ep IN (SELECT a FROM links)) GROUP BY identity_group""",
    mixed="SELECT ep, path, CASE WHEN ep % 5 = 1 THEN 'fx://' || " + PATH.replace(TWO, TWO.replace("ep::", "(ep - 1)::")) + " ELSE source_uri END AS source_uri,"
    " CASE WHEN ep % 9 IN (1, 2, 3) THEN sha256((ep // 9)::VARCHAR) ELSE lfs_oid END AS sha256 FROM eps",
    named="SELECT *, CASE WHEN count(*) OVER (PARTITION BY path) > 1 THEN 'path=' || path END AS p, CASE WHEN count(*) OVER (PARTITION BY source_uri) > 1 THEN 'source_uri=' || source_uri END AS u,"
    " CASE WHEN count(*) OVER (PARTITION BY sha256) > 1 THEN 'sha256=' || sha256 END AS s FROM mixed",
    links="SELECT a.ep AS a, b.ep AS b FROM named a JOIN named b ON a.ep <> b.ep AND (a.path = b.path OR a.source_uri = b.source_uri OR a.sha256 = b.sha256)",
    steps="SELECT a, b FROM links UNION SELECT ep, ep FROM named",
    reach="SELECT DISTINCT x.a, w.b FROM steps x JOIN steps y ON y.a = x.b JOIN steps z ON z.a = y.b JOIN steps w ON w.a = z.b",
)
ORACLE_SQL["linked_rig_cohorts"] = sql(
    f"""SELECT rig, count(DISTINCT name) AS cohorts, count(*) AS files, sum(offset_count)::BIGINT AS pose_records, {r('min(y)')} AS least_y, {r('max(y)')} AS most_y
FROM cells JOIN (SELECT a AS name, min(b) AS rig FROM reach GROUP BY a) USING (name) WHERE offset_count > 0 GROUP BY rig
UNION ALL SELECT NULL, 0, count(*), sum(offset_count)::BIGINT, NULL, NULL FROM cells WHERE offset_count = 0 HAVING count(*) > 0""",
    moved="SELECT ep, offset_count, offset_mean_x AS x, offset_mean_y + CASE WHEN ep % 2 = 0 THEN 0.0051 ELSE 0.0049 END::DOUBLE AS y, offset_mean_z AS z"
    " FROM right_ JOIN eps USING (source_uri)",
    places="SELECT *, round_even(x * 100, 0)::BIGINT AS kx, round_even(y * 100, 0)::BIGINT AS ky, round_even(z * 100, 0)::BIGINT AS kz FROM moved",
    cells="SELECT *, printf('%+07d,%+07d,%+07d', kx, ky, kz) AS name FROM places",
    boxes="SELECT name, kx, ky, kz, min(x) AS lox, max(x) AS hix, min(y) AS loy, max(y) AS hiy, min(z) AS loz, max(z) AS hiz FROM cells WHERE offset_count > 0 GROUP BY ALL",
    steps="SELECT a.name AS a, b.name AS b FROM boxes a JOIN boxes b ON abs(a.kx - b.kx) <= 1 AND greatest(a.lox - b.hix, b.lox - a.hix) <= 0.002 AND abs(a.ky - b.ky) <= 1 AND greatest(a.loy - b.hiy, b.loy - a.hiy) <= 0.002 AND abs(a.kz - b.kz) <= 1 AND greatest(a.loz - b.hiz, b.loz - a.hiz) <= 0.002",
    twice="SELECT DISTINCT x.a, y.b FROM steps x JOIN steps y ON y.a = x.b",
    reach="SELECT DISTINCT x.a, y.b FROM twice x JOIN twice y ON y.a = x.b",
)
ORACLE_SQL["file_skipping"] = sql(
    f"SELECT topic, half, count(*) FILTER (half = 'all' OR (half = 'first') = (log_time_ns < middle)) AS n, 0::BIGINT AS in_vain, true AS some_stay_closed"
    f" FROM (SELECT topic, log_time_ns, (min(log_time_ns) OVER () + max(log_time_ns) OVER ()) // 2 AS middle FROM msg WHERE ep % 5 <> 4), (SELECT unnest(['all', 'first', 'second']) AS half)"
    f" WHERE topic IN ({TOPIC_LIST}) GROUP BY topic, half"
)
ORACLE_SQL["audit_of_record_files"] = ORACLE_SQL["file_audit_verdict"]
