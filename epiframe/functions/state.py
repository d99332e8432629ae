"""Joint state and action vectors."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiframe.schema import named

# Layout of the flat observation vector (first position, length).
JOINT_POS = (0, 6)
JOINT_VEL = (6, 6)
LAST_ACTION = (12, 6)
OBJECT_POSE = (18, 7)
MOTOR_SUFFIX = ".pos"
IMAGE_PREFIX = "observation.images."


def _zeros(n: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), n)


def _part(vector: Column, part: tuple[int, int]) -> Column:
    return F.slice(vector, part[0] + 1, part[1])


def split_state(flat: Column, include_object_pose: bool = False) -> Column:
    """State from a flat observation: joint positions, with the object pose on request.

    A vector too short to hold the pose gives a zero pose; one too short to hold
    the joint positions gives an all-zero state, not a padded one.
    """
    flat = F.coalesce(flat.cast("array<float>"), _zeros(JOINT_POS[1]))
    joints = _part(flat, JOINT_POS)
    if not include_object_pose:
        return F.when(F.size(flat) >= JOINT_POS[1], joints).otherwise(_zeros(JOINT_POS[1]))
    pose = F.when(F.size(flat) >= sum(OBJECT_POSE), _part(flat, OBJECT_POSE)).otherwise(_zeros(OBJECT_POSE[1]))
    state = F.concat(joints, pose)
    width = JOINT_POS[1] + OBJECT_POSE[1]
    return F.when(F.size(state) >= width, state).otherwise(_zeros(width))


def assemble_state_terms(joint_pos: Column, object_pose: Column | None = None) -> Column:
    """State from separate terms; an absent term counts as zeros."""
    joints = F.slice(F.coalesce(joint_pos.cast("array<float>"), _zeros(JOINT_POS[1])), 1, JOINT_POS[1])
    width = JOINT_POS[1]
    state = joints
    if object_pose is not None:
        pose = F.coalesce(object_pose.cast("array<float>"), _zeros(OBJECT_POSE[1]))
        state = F.concat(joints, F.slice(pose, 1, OBJECT_POSE[1]))
        width += OBJECT_POSE[1]
    return F.when(F.size(state) >= width, F.slice(state, 1, width)).otherwise(_zeros(width))


def object_pose(flat: Column) -> Column:
    """The pose of a flat observation as struct(pos, quat)."""
    pose = _part(flat, OBJECT_POSE)
    return F.struct(F.slice(pose, 1, 3).alias("pos"), F.slice(pose, 4, 4).alias("quat"))


def motor_columns(df: DataFrame) -> list[str]:
    return sorted(c for c in df.columns if c.endswith(MOTOR_SUFFIX))


def motors_to_state(df: DataFrame, out: str = "observation.state") -> DataFrame:
    """Gather all motor position columns into one vector, in the order of their names."""
    motors = motor_columns(df)
    vector = F.array(*[named(c).cast("float") for c in motors])
    return df.select(*[named(c) for c in df.columns if c not in motors], vector.alias(out))


def action_to_columns(df: DataFrame, motor_names: Sequence[str], action: str = "action") -> DataFrame:
    """Spread an action vector over named motor columns, in the given order."""
    n = len(motor_names)
    vector = named(action)
    wrong = F.raise_error(
        F.concat(F.lit("action has "), F.size(vector).cast("string"), F.lit(f" values for {n} motors"))
    )
    checked = F.when(F.size(vector) == n, vector).otherwise(wrong.cast("array<double>"))
    kept = [named(c) for c in df.columns if c != action]
    spread = [checked[i].cast("double").alias(f"{m}{MOTOR_SUFFIX}") for i, m in enumerate(motor_names)]
    return df.select(*kept, *spread)


def rename_image_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Prefix every column that is neither a motor position nor listed in ``keep``."""
    return df.select(
        *[
            named(c) if c.endswith(MOTOR_SUFFIX) or c in keep else named(c).alias(IMAGE_PREFIX + c)
            for c in df.columns
        ]
    )
