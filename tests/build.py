"""Small message and frame tables for the tests, with poses derived outside Spark."""

import math

from posefold import contracts as C
from posefold.functions.kinematics import SIX_JOINT_ARM, rotation_of

JOINTS = [-0.48, 0.71, 0.70, -0.70, -0.012, -0.13]


def derive(joints, model=SIX_JOINT_ARM):
    """Plain matrix product of the chain: 4x4 row-major list, written independently of the columns."""
    position, rotation = [0.0, 0.0, 0.0], [[1.0, 0, 0], [0, 1.0, 0], [0, 0, 1.0]]

    def times(a, b):
        return [[sum(a[i][k] * b[k][j] for k in range(3)) for j in range(3)] for i in range(3)]

    def step(offset, fixed, angle):
        nonlocal position, rotation
        position = [position[i] + sum(rotation[i][k] * offset[k] for k in range(3)) for i in range(3)]
        c, s = math.cos(angle), math.sin(angle)
        rotation = times(times(rotation, rotation_of(fixed)), [[c, -s, 0], [s, c, 0], [0, 0, 1]])

    for hinge, angle in zip(model.hinges, joints):
        step(hinge.offset, hinge.quaternion, angle)
    step(model.site_offset, model.site_quaternion, 0.0)
    rows = [[*rotation[i], position[i]] for i in range(3)] + [[0.0, 0.0, 0.0, 1.0]]
    return [value for row in rows for value in row]


def recorded(joints=JOINTS, arm="left", y=-0.61):
    pose = derive(joints)
    if arm == "right":
        pose[7] += y
    return pose


def message(topic="/left-arm-state", pose=None, position=None, n=0, source="fx://a", ordinal=None, error=None):
    return (source, topic, 1000 + n, 900 + n, n, ordinal, pose, position, error)


def messages(spark, rows):
    from decimal import Decimal

    rows = [(s, t, Decimal(a), Decimal(b), q, o, p, j, e) for s, t, a, b, q, o, p, j, e in rows]
    return spark.createDataFrame(rows, C.ARM_MESSAGES)
