"""Row-local classification of recorded poses, joint vectors and 14-value frame vectors.

Array elements are pulled out once into non-nullable scalar columns (a null element reads as NaN), so
every test below is plain arithmetic inside generated code rather than a lambda over an array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posefold import contracts as C
from posefold.functions.rotation import ROTATION
from posefold.functions.spans import end_of_span

_NAN = "double('NaN')"


def element(array: str, index: int) -> str:
    """SQL text of one element; past the end, null array and null element all read as NaN."""
    return f"coalesce(get({array}, {index}), {_NAN})"


def finite(names: list[str]) -> str:
    """SQL text: true when every (non-null) scalar is finite."""
    return "(" + " + ".join(f"{n} * 0D" for n in names) + ") = 0D"


def vector_is_finite(array: str) -> Column:
    """True when no element of an array of any length is null, NaN or infinite."""
    return F.forall(
        array,
        lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))),
    )


def _states(array: str, expected: int, finite_flag: str) -> list[tuple[str, str, str]]:
    label = "pose" if expected == C.POSE_LENGTH else "position"
    return [
        (f"{array} IS NULL", "missing", f"'{label} is absent'"),
        (f"size({array}) = 0", "missing", f"'{label} is empty'"),
        (
            f"size({array}) <> {expected}",
            "malformed",
            f"concat('{label} length ', size({array}), ', need {expected}')",
        ),
        (f"NOT ({finite_flag})", "nonfinite", f"'{label} holds NaN or infinity'"),
    ]


def _case(rules: list[tuple[str, str, str]], pick: int, otherwise: str) -> str:
    branches = " ".join(
        f"WHEN {rule[0]} THEN " + (f"'{rule[1]}'" if pick == 1 else rule[2]) for rule in rules
    )
    return f"CASE {branches} ELSE {otherwise} END"


def with_pose_status(df: DataFrame, prefix: str = "rec_", details: bool = False) -> DataFrame:
    """Add ``pose_status`` and the recorded pose's twelve scalars ``<prefix>x .. <prefix>r22``.

    The first failing test names the class: absent or empty, wrong length, any non-finite value, a
    bottom row other than (0, 0, 0, 1), a rotation that is not orthonormal, a determinant other than 1.
    """
    p = prefix
    carried = [f"`{c}`" for c in df.columns]
    slots = {f"r{i}{j}": 4 * i + j for i in range(3) for j in range(3)}
    slots |= {"x": 3, "y": 7, "z": 11, "b0": 12, "b1": 13, "b2": 14, "b3": 15}
    df = df.selectExpr(*carried, *(f"{element('pose', i)} AS {p}{n}" for n, i in slots.items()))

    gram = {
        f"{p}g{i}{j}": " + ".join(f"{p}r{k}{i} * {p}r{k}{j}" for k in range(3))
        for i in range(3)
        for j in range(i, 3)
    }
    r = {name: f"{p}{name}" for name in ROTATION}
    determinant = (
        f"{r['r00']} * ({r['r11']} * {r['r22']} - {r['r12']} * {r['r21']})"
        f" - {r['r01']} * ({r['r10']} * {r['r22']} - {r['r12']} * {r['r20']})"
        f" + {r['r02']} * ({r['r10']} * {r['r21']} - {r['r11']} * {r['r20']})"
    )
    df = df.selectExpr(
        *(f"`{c}`" for c in df.columns),
        *(f"{text} AS {name}" for name, text in gram.items()),
        f"{determinant} AS {p}det",
        f"{finite([f'{p}{n}' for n in slots])} AS {p}finite",
    )
    bottom = " AND ".join(
        f"abs({p}b{i} - {target}D) <= {C.BOTTOM_ROW_ATOL!r}D" for i, target in enumerate((0, 0, 0, 1))
    )
    orthonormal = " AND ".join(
        f"abs({name} - {1 if name[-1] == name[-2] else 0}D) <= {C.ROTATION_ATOL!r}D" for name in gram
    )
    rules = _states("pose", C.POSE_LENGTH, f"{p}finite") + [
        (f"NOT ({bottom})", "malformed", "'bottom row is not (0, 0, 0, 1)'"),
        (f"NOT ({orthonormal})", "malformed", "'rotation is not orthonormal'"),
        (
            f"NOT (abs({p}det - 1D) <= {C.ROTATION_ATOL!r}D)",
            "malformed",
            "'rotation determinant is not +1'",
        ),
    ]
    added = [f"{_case(rules, 1, repr('intact'))} AS pose_status"]
    if details:
        added.append(f"{_case(rules, 2, 'NULL')} AS pose_detail")
    df = df.selectExpr(*carried, *(f"{p}{n}" for n in (*"xyz", *ROTATION)), *added)
    return end_of_span(df, f"{p}x")


def with_joint_status(df: DataFrame, prefix: str = "q", details: bool = False) -> DataFrame:
    """Add ``joint_status`` and the six angles ``<prefix>0 .. <prefix>5`` (NaN where absent)."""
    carried = [f"`{c}`" for c in df.columns]
    names = [f"{prefix}{i}" for i in range(C.JOINT_COUNT)]
    df = df.selectExpr(*carried, *(f"{element('position', i)} AS {n}" for i, n in enumerate(names)))
    rules = _states("position", C.JOINT_COUNT, finite(names))
    added = [f"{_case(rules, 1, repr('intact'))} AS joint_status"]
    if details:
        added.append(f"{_case(rules, 2, 'NULL')} AS joint_detail")
    return df.selectExpr(*carried, *names, *added)


def pose_status_only(df: DataFrame) -> DataFrame:
    """:func:`with_pose_status` without the scalars."""
    return with_pose_status(df).select(*df.columns, "pose_status")


def joint_status_only(df: DataFrame) -> DataFrame:
    """:func:`with_joint_status` without the angles."""
    return with_joint_status(df).select(*df.columns, "joint_status")


def limb_joints(limb: C.Limb) -> list[str]:
    """SQL texts of one arm's six angles inside its 14-value vector."""
    return [element(limb.vector, limb.start + i) for i in range(C.JOINT_COUNT)]


def limb_is_usable(limb: C.Limb) -> str:
    """SQL text: the vector has 14 values and this arm's six are finite; grippers are never read."""
    return (
        f"coalesce(size({limb.vector}) = {C.VECTOR_LENGTH}, false)"
        f" AND {finite([f'({joint})' for joint in limb_joints(limb)])}"
    )


def arm_of(topic: str = "topic") -> Column:
    """The arm of a target topic, null for any other topic."""
    return _topic_lookup(topic, 0)


def stream_of(topic: str = "topic") -> Column:
    """The stream (state or action) of a target topic, null for any other topic."""
    return _topic_lookup(topic, 1)


def _topic_lookup(topic: str, field: int) -> Column:
    branches = " ".join(f"WHEN '{name}' THEN '{pair[field]}'" for name, pair in C.ARM_TOPICS.items())
    return F.expr(f"CASE {topic} {branches} END")


def is_target_topic(topic: str = "topic") -> Column:
    return F.col(topic).isin(*C.ARM_TOPICS)


def is_plot_topic(topic: str = "topic") -> Column:
    """Generated duplicates carry a ``.plot`` suffix."""
    return F.endswith(F.col(topic), F.lit(C.PLOT_SUFFIX))


def fk_status(joint_status: str = "joint_status", fk_ok: str = "fk_ok") -> Column:
    return F.expr(
        f"CASE WHEN {joint_status} <> 'intact' THEN 'not_attempted_invalid_joints'"
        f" WHEN {fk_ok} THEN 'derived' ELSE 'failure' END"
    )


def recovery_status(
    pose_status: str = "pose_status", fk: str = "fk_status"
) -> Column:
    """Six outcomes: recorded pose kept or rebuilt, and why a rebuild was refused."""
    intact = f"{pose_status} = 'intact'"
    # The six status words.
    return F.expr(
        f"CASE WHEN {fk} = 'derived' AND {intact} THEN 'source_pose_intact'"
        f" WHEN {fk} = 'derived' THEN 'recovered'"
        f" WHEN {fk} = 'failure' AND {intact} THEN 'source_pose_intact_fk_failure'"
        f" WHEN {fk} = 'failure' THEN 'unrecoverable_fk_failure'"
        f" WHEN {intact} THEN 'source_pose_intact_invalid_joints'"
        f" ELSE 'unrecoverable_invalid_joints' END"
    )


def recovery_mask(
    pose_status: str = "pose_status", joint_status: str = "joint_status", fk: str = "fk_status"
) -> Column:
    """Bits: 0 pose intact, 1 joints intact, 2 FK valid, 3 recovered."""
    facts = {
        "source_pose_intact": f"{pose_status} = 'intact'",
        "joints_intact": f"{joint_status} = 'intact'",
        "fk_valid": f"{fk} = 'derived'",
        "recovered": f"{pose_status} <> 'intact' AND {fk} = 'derived'",
    }
    return bit_mask({C.RECOVERY_BITS[name]: fact for name, fact in facts.items()})


def bit_mask(facts: dict[int, str]) -> Column:
    """A small-integer mask with bit ``k`` set where the k-th fact (SQL text) is true."""
    text = " | ".join(f"IF({fact}, {1 << bit}, 0)" for bit, fact in facts.items())
    return F.expr(text).cast("smallint")


def bit_is_set(mask: str, bit: int) -> Column:
    return F.expr(f"bit_get({mask}, {bit}) = 1")
