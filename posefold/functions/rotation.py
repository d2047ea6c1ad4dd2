"""Rotations, quaternions and residuals between poses held as scalar columns.

A pose with prefix ``p`` is the twelve columns ``px py pz pr00 .. pr22``; its quaternion is
``pqw pqx pqy pqz`` (scalar first).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posefold.functions.spans import end_of_span

ROTATION = tuple(f"r{i}{j}" for i in range(3) for j in range(3))
POSE_SCALARS = ("x", "y", "z", *ROTATION)
QUATERNION = ("qw", "qx", "qy", "qz")


def with_quaternion(df: DataFrame, prefix: str, drop_rotation: bool = True) -> DataFrame:
    """Replace (or accompany) the rotation columns with a unit quaternion of canonical sign.

    The numerically largest of the four components is found first, so no square root is taken of a
    value near zero.
    """
    p = prefix
    rotation = {f"{p}{name}" for name in ROTATION}
    carried = [f"`{c}`" for c in df.columns if not (drop_rotation and c in rotation)]
    r = {name: f"{p}{name}" for name in ROTATION}
    df = df.selectExpr(
        *(f"`{c}`" for c in df.columns),
        f"1D + {r['r00']} + {r['r11']} + {r['r22']} AS {p}t0",
        f"1D + {r['r00']} - {r['r11']} - {r['r22']} AS {p}t1",
        f"1D - {r['r00']} + {r['r11']} - {r['r22']} AS {p}t2",
        f"1D - {r['r00']} - {r['r11']} + {r['r22']} AS {p}t3",
        f"{r['r21']} - {r['r12']} AS {p}d1",
        f"{r['r02']} - {r['r20']} AS {p}d2",
        f"{r['r10']} - {r['r01']} AS {p}d3",
        f"{r['r10']} + {r['r01']} AS {p}m12",
        f"{r['r02']} + {r['r20']} AS {p}m13",
        f"{r['r21']} + {r['r12']} AS {p}m23",
    )
    df = df.selectExpr(
        *carried,
        *(f"{p}{name}" for name in ("t0", "t1", "t2", "t3", "d1", "d2", "d3", "m12", "m13", "m23")),
        f"CASE WHEN {p}t0 >= 1D THEN 0 WHEN {p}t1 >= {p}t2 AND {p}t1 >= {p}t3 THEN 1"
        f" WHEN {p}t2 >= {p}t3 THEN 2 ELSE 3 END AS {p}k",
    )
    # Component k is proportional to its own t; the others are sums or differences of entries.
    rows = {
        "qw": ("t0", "d1", "d2", "d3"),
        "qx": ("d1", "t1", "m12", "m13"),
        "qy": ("d2", "m12", "t2", "m23"),
        "qz": ("d3", "m13", "m23", "t3"),
    }
    df = df.selectExpr(
        *carried,
        *(
            f"CASE {p}k WHEN 0 THEN {p}{a} WHEN 1 THEN {p}{b} WHEN 2 THEN {p}{c} ELSE {p}{d} END"
            f" AS {p}{name}"
            for name, (a, b, c, d) in rows.items()
        ),
    )
    return with_canonical_quaternion(df, p)


def with_canonical_quaternion(df: DataFrame, prefix: str) -> DataFrame:
    """Normalise ``<prefix>qw..qz`` in place and flip the sign where the scalar part is negative."""
    p = prefix
    parts = [f"{p}{name}" for name in QUATERNION]
    carried = [f"`{c}`" for c in df.columns if c not in parts]
    squares = " + ".join(f"{q} * {q}" for q in parts)
    df = df.selectExpr(
        *carried, *parts, f"sqrt({squares}) * IF({p}qw < 0D, -1D, 1D) AS {p}norm"
    )
    df = end_of_span(df, f"{p}norm")
    # A zero quaternion has no direction: leave it as it is, the caller's validity flag refuses it.
    return df.selectExpr(
        *carried, *(f"{q} / IF({p}norm = 0D, 1D, {p}norm) AS {q}" for q in parts)
    )


def matrix_from_quaternion(prefix: str) -> dict[str, str]:
    """SQL text of the nine rotation entries of the unit quaternion ``<prefix>qw..qz``."""
    w, x, y, z = (f"{prefix}{name}" for name in QUATERNION)
    return {
        "r00": f"1D - 2D * ({y} * {y} + {z} * {z})",
        "r01": f"2D * ({x} * {y} - {w} * {z})",
        "r02": f"2D * ({x} * {z} + {w} * {y})",
        "r10": f"2D * ({x} * {y} + {w} * {z})",
        "r11": f"1D - 2D * ({x} * {x} + {z} * {z})",
        "r12": f"2D * ({y} * {z} - {w} * {x})",
        "r20": f"2D * ({x} * {z} - {w} * {y})",
        "r21": f"2D * ({y} * {z} + {w} * {x})",
        "r22": f"1D - 2D * ({x} * {x} + {y} * {y})",
    }


def homogeneous(prefix: str) -> Column:
    """The row-major 4x4 matrix of a pose held as twelve scalars."""
    p = prefix
    rows = [f"{p}r{i}0, {p}r{i}1, {p}r{i}2, {p}{axis}" for i, axis in enumerate("xyz")]
    return F.expr(f"array({', '.join(rows)}, 0D, 0D, 0D, 1D)")


def pose_vector(prefix: str) -> Column:
    """``[x, y, z, qw, qx, qy, qz]`` of a pose whose quaternion has been attached."""
    return F.expr(f"array({', '.join(f'{prefix}{n}' for n in ('x', 'y', 'z', *QUATERNION))})")


def translation_error(recorded: str, derived: str, offset: tuple[str, str, str]) -> Column:
    """Distance between two positions after moving the derived one by ``offset`` (SQL texts)."""
    deltas = [f"({recorded}{a} - ({derived}{a} + {o}))" for a, o in zip("xyz", offset)]
    return F.expr("sqrt(" + " + ".join(f"{d} * {d}" for d in deltas) + ")")


def rotation_error_deg(recorded: str, derived: str) -> Column:
    """Angle in degrees between two rotations. Both must be finite: ``least`` would hide a NaN."""
    trace = " + ".join(f"{derived}{n} * {recorded}{n}" for n in ROTATION)
    return F.expr(f"degrees(acos(greatest(-1D, least(1D, ({trace} - 1D) / 2D))))")
