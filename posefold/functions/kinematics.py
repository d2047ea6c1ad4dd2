"""Forward kinematics of a serial hinge chain, written as Spark column expressions.

A :class:`ChainModel` holds the constants of the chain. :func:`with_chain_pose` turns it into a few
staged projections: one for the sines and cosines and one per joint. Each stage carries twelve scalar
columns (three for position, nine for rotation), so the expression size grows linearly with the
number of joints. The inputs are made non-nullable up front, which keeps null handling out of the
inner arithmetic, and the stages form a generated-code span of their own, small enough for the JIT.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posefold.functions.rotation import matrix_from_quaternion, with_quaternion
from posefold.functions.spans import end_of_span

_SNAP = 1e-15


@dataclass(frozen=True)
class Hinge:
    """A link offset, its fixed rotation (wxyz, any norm) and the joint's range in radians."""

    offset: tuple[float, float, float]
    quaternion: tuple[float, float, float, float]
    limits: tuple[float, float]


@dataclass(frozen=True)
class ChainModel:
    """Constants and identity of one serial chain whose joints turn about their local z axis."""

    name: str
    revision: str
    hinges: tuple[Hinge, ...]
    site_offset: tuple[float, float, float]
    site_quaternion: tuple[float, float, float, float]

    @property
    def digest(self) -> str:
        text = json.dumps(asdict(self), sort_keys=True, separators=(",", ":"))
        return hashlib.sha256(text.encode()).hexdigest()

    @property
    def identity(self) -> str:
        return f"{self.revision}#sha256:{self.digest}"


# Offsets (metres), rotations (wxyz, not normalised) and ranges (radians) of the arm.
SIX_JOINT_ARM = ChainModel(
    name="six_joint_arm",
    revision="six-joint-arm/1",
    hinges=(
        Hinge((0, 0, 0.0631), (1, 0, 0, 1), (-2.61799, 3.05433)),
        Hinge((2.5e-05, -0.02, 0.0409), (1, 1, 1, 1), (0, 3.66519)),
        Hinge((0.264, 0, 0), (0, 1, 0, 0), (0, 3.66519)),
        Hinge((-0.245, -0.06, 0), (1, 0, 0, 0), (-1.5708, 1.5708)),
        Hinge((-0.074, -0.0395, 2.5e-05), (1, -1, 1, 1), (-1.5708, 1.5708)),
        Hinge((0, 0.0353, 0.0395), (1, -1, 0, 0), (-2.0944, 2.0944)),
    ),
    site_offset=(0, 0, 0.1347),
    site_quaternion=(1, 0, 0, -1),
)


def rotation_of(quaternion: Sequence[float]) -> list[list[float]]:
    """Rotation matrix of a wxyz quaternion of any norm; entries within 1e-15 of -1, 0, 1 are snapped."""
    w, x, y, z = (value / math.hypot(*quaternion) for value in quaternion)
    raw = [
        [1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)],
        [2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)],
        [2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)],
    ]
    return [[_snap(value) for value in row] for row in raw]


def _snap(value: float) -> float:
    nearest = float(round(value))
    return nearest if abs(value - nearest) < _SNAP else value


# --- symbolic terms: a float is a constant, a str is SQL text -------------------------------------


def _mul(a: float | str, b: float | str) -> float | str:
    if isinstance(a, str) and not isinstance(b, str):
        a, b = b, a
    if isinstance(a, str):
        return f"({a} * {b})"
    if not isinstance(b, str):
        return a * b
    if a == 0:
        return 0.0
    if a == 1:
        return b
    return f"(-{b})" if a == -1 else f"({a!r}D * {b})"


def _sum(*terms: float | str) -> float | str:
    constant = sum(term for term in terms if not isinstance(term, str))
    parts = [term for term in terms if isinstance(term, str)]
    if not parts:
        return float(constant)
    if constant:
        parts.append(f"{constant!r}D")
    return parts[0] if len(parts) == 1 else "(" + " + ".join(parts) + ")"


def _text(term: float | str) -> str:
    return term if isinstance(term, str) else f"{float(term)!r}D"


def _compose(rotation: list[list], constant: list[list[float]]) -> list[list]:
    return [
        [_sum(*(_mul(rotation[i][k], constant[k][j]) for k in range(3))) for j in range(3)]
        for i in range(3)
    ]


def with_chain_pose(
    df: DataFrame, joints: Sequence[str], prefix: str, model: ChainModel = SIX_JOINT_ARM
) -> DataFrame:
    """Add ``<prefix>x .. <prefix>r22``: the site pose in the base frame of the chain.

    ``joints`` are SQL expressions, one per hinge. Null joints are read as zero so that every stage
    stays non-nullable; callers keep their own validity flag and must mask the result with it.
    """
    if len(joints) != len(model.hinges):
        raise ValueError(f"{model.name} needs {len(model.hinges)} joints, got {len(joints)}")
    angles = [f"{prefix}a{i}" for i in range(len(joints))]
    trig = [f"{prefix}{f}{i}" for i in range(len(joints)) for f in "sc"]
    df = df.selectExpr("*", *(f"coalesce({j}, 0D) AS {a}" for j, a in zip(joints, angles)))
    df = df.selectExpr(
        f"* EXCEPT ({', '.join(angles)})",
        *(f"sin({angle}) AS {prefix}s{i}" for i, angle in enumerate(angles)),
        *(f"cos({angle}) AS {prefix}c{i}" for i, angle in enumerate(angles)),
    )

    position: list[float | str] = [0.0, 0.0, 0.0]
    rotation: list[list[float | str]] = [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]]
    last = len(model.hinges)
    current: list[str] = []
    for i in range(last + 1):
        hinge = model.hinges[i] if i < last else None
        offset = hinge.offset if hinge else model.site_offset
        fixed = rotation_of(hinge.quaternion if hinge else model.site_quaternion)
        position = [
            _sum(position[axis], *(_mul(rotation[axis][k], float(offset[k])) for k in range(3)))
            for axis in range(3)
        ]
        rotation = _compose(rotation, fixed)
        if hinge:
            sine, cosine = f"{prefix}s{i}", f"{prefix}c{i}"
            rotation = [
                [
                    _sum(_mul(row[0], cosine), _mul(row[1], sine)),
                    _sum(_mul(row[1], cosine), _mul(-1.0, _mul(row[0], sine))),
                    row[2],
                ]
                for row in rotation
            ]
        # Materialise this joint's frame as named columns in place of the previous one; constants stay
        # constants until the last stage. Sines and cosines leave once they are used.
        named = {f"{prefix}{axis}": position[k] for k, axis in enumerate("xyz")}
        named |= {f"{prefix}r{r}{c}": rotation[r][c] for r in range(3) for c in range(3)}
        kept = {n: v for n, v in named.items() if i == last or isinstance(v, str)}
        spent = current + (trig[2 * i : 2 * i + 2] if hinge else [])
        df = df.selectExpr(f"* EXCEPT ({', '.join(spent)})", *(f"{_text(v)} AS {n}" for n, v in kept.items()))
        current = list(kept)
        position = [_name_or_value(named, kept, f"{prefix}{axis}") for axis in "xyz"]
        rotation = [
            [_name_or_value(named, kept, f"{prefix}r{r}{c}") for c in range(3)] for r in range(3)
        ]
    return end_of_span(df, f"{prefix}x")


def _name_or_value(named: dict, kept: dict, name: str) -> float | str:
    return name if name in kept else named[name]


# --- adapters ------------------------------------------------------------------------------------


class ChainKinematics:
    """The native adapter: a :class:`ChainModel` compiled to columns."""

    frame = "arm_local"

    def __init__(self, model: ChainModel = SIX_JOINT_ARM):
        self.model = model
        self.model_name = model.identity
        self.model_digest = model.digest
        self.model_revision = model.revision

    def attach(
        self, df: DataFrame, joints: Sequence[str], prefix: str, ok: str, arm: str | None = None
    ) -> DataFrame:
        """Add the twelve pose scalars and ``<prefix>ok``, which is ``ok`` itself.

        Sines and cosines of finite angles are finite, and so is every sum of their products with
        constants: usable joints always give a finite pose. Keeping the flag free of the pose also
        keeps filters on it cheap, since Catalyst moves them below the stages by substitution.
        """
        df = df.withColumn(f"{prefix}ok", F.expr(ok))
        return with_chain_pose(df, joints, prefix, self.model)

    def attach_vector(
        self, df: DataFrame, joints: Sequence[str], prefix: str, ok: str, arm: str | None = None
    ) -> DataFrame:
        """Add ``<prefix>ok`` and the pose as ``<prefix>x .. <prefix>z, <prefix>qw .. <prefix>qz``."""
        return with_quaternion(self.attach(df, joints, prefix, ok, arm), prefix)


class FunctionKinematics:
    """Adapter for any Python model: ``fn(joints[n, 6], arms[n]) -> poses[n, 7]`` (xyz + wxyz).

    Batches travel over Arrow. When ``fn`` raises on a batch it is called again row by row, so an
    exception marks only the row that caused it. A wrong length, a non-finite value or a zero
    quaternion is a failure too. ``frame`` says which frame ``fn`` reports; with
    ``"shared_bimanual"`` there is no arm-local pose and offset statistics stay empty.
    """

    def __init__(
        self,
        fn: Callable[[np.ndarray, np.ndarray], np.ndarray],
        name: str | None = None,
        digest: str | None = None,
        revision: str | None = None,
        frame: str = "arm_local",
    ):
        if frame not in ("arm_local", "shared_bimanual"):
            raise ValueError(f"unknown frame {frame!r}")
        self.fn, self.frame = fn, frame
        self.model_name = name or getattr(fn, "__name__", type(fn).__name__)
        self.model_digest, self.model_revision = digest, revision

    def attach_vector(
        self, df: DataFrame, joints: Sequence[str], prefix: str, ok: str, arm: str | None = None
    ) -> DataFrame:
        """Add ``<prefix>ok`` and the pose as ``<prefix>x .. <prefix>z, <prefix>qw .. <prefix>qz``."""
        fn = self.fn

        @F.pandas_udf("array<double>")
        def call(values: pd.Series, arms: pd.Series) -> pd.Series:
            return pd.Series(_call_rows(fn, values, arms))

        carried = df.columns
        arms = F.expr(arm) if arm else F.lit(None).cast("string")
        inputs = F.when(F.expr(ok), F.expr(f"array({', '.join(joints)})"))
        df = df.withColumn(f"{prefix}v", call(inputs, arms))
        parts = ("x", "y", "z", "qw", "qx", "qy", "qz")
        return df.select(
            *carried,
            F.col(f"{prefix}v").isNotNull().alias(f"{prefix}ok"),
            *(
                F.expr(f"coalesce(get({prefix}v, {i}), 0D) AS {prefix}{part}")
                for i, part in enumerate(parts)
            ),
        )

    def attach(
        self, df: DataFrame, joints: Sequence[str], prefix: str, ok: str, arm: str | None = None
    ) -> DataFrame:
        """Add ``<prefix>ok`` and the twelve pose scalars."""
        carried = df.columns
        df = self.attach_vector(df, joints, prefix, ok, arm)
        return df.select(
            *carried,
            f"{prefix}ok",
            *(f"{prefix}{axis}" for axis in "xyz"),
            *(
                F.expr(text).alias(f"{prefix}{name}")
                for name, text in matrix_from_quaternion(prefix).items()
            ),
        )


def _call_rows(fn: Callable, values: pd.Series, arms: pd.Series) -> list:
    present = np.flatnonzero(values.notna().to_numpy())
    out: list = [None] * len(values)
    if not len(present):
        return out
    joints = np.stack(values.to_numpy()[present]).astype(np.float64)
    poses = _call_halves(fn, joints, arms.to_numpy()[present])
    norms = np.linalg.norm(poses[:, 3:], axis=1)
    usable = np.isfinite(poses).all(axis=1) & (norms > np.finfo(np.float64).eps)
    present, poses, norms = present[usable], poses[usable], norms[usable]
    # A unit quaternion whose scalar part is not negative.
    poses[:, 3:] /= (norms * np.where(poses[:, 3] < 0, -1.0, 1.0))[:, None]
    for i, pose in zip(present.tolist(), poses):
        out[i] = pose
    return out


def _call_halves(fn: Callable, joints: np.ndarray, arms: np.ndarray) -> np.ndarray:
    """A pose of seven values for every row, not finite where ``fn`` fails. Where it raises on rows it is called on each
    half of them, so the calls grow with the rows that raise and not with those beside them."""
    try:
        poses = np.array(fn(joints, arms), dtype=np.float64)
        if len(joints) == 1:
            poses = poses.reshape(1, -1)
        if poses.ndim != 2 or len(poses) != len(joints):
            raise ValueError("adapter returned another number of rows")
        return poses if poses.shape[1] == 7 else np.full((len(joints), 7), np.nan)
    except Exception:
        if len(joints) == 1:
            return np.full((1, 7), np.nan)
        half = len(joints) // 2
        return np.concatenate([_call_halves(fn, joints[part], arms[part]) for part in (slice(half), slice(half, None))])


def joint_limit_flags(joints: Sequence[str], model: ChainModel = SIX_JOINT_ARM) -> list[Column]:
    """One boolean per hinge: true where the angle lies inside the declared range (inclusive)."""
    return [
        F.expr(f"{joint} BETWEEN {float(low)!r}D AND {float(high)!r}D")
        for joint, (low, high) in zip(joints, (hinge.limits for hinge in model.hinges))
    ]
