"""The frame table and the fixed values its format prescribes."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the recording format.
FPS = 30
STATE_NAMES = [f"joint_pos_{i}" for i in range(6)] + [f"joint_vel_{i}" for i in range(6)]
ACTION_NAMES = [f"joint_{i}" for i in range(6)]
IMAGE_SHAPE = [480, 640, 3]
STATE = "observation.state"
WRIST = "observation.images.wrist"
OVERHEAD = "observation.images.overhead"

# Bytes per value of the types that vectors are made of.
VALUE_BYTES = {
    T.ByteType: 1, T.BooleanType: 1, T.BinaryType: 1, T.ShortType: 2, T.IntegerType: 4,
    T.FloatType: 4, T.LongType: 8, T.DoubleType: 8,
}

EPISODE = ("episode_index",)
POSITION = "frame_index"


def named(column: str) -> Column:
    """A column by its whole name; dots in it are part of the name."""
    return F.col(f"`{column}`")


def _field(name, dtype, shape=None, names=None):
    meta = {}
    if shape is not None:
        meta["shape"] = shape
    if names is not None:
        meta["names"] = names
    return T.StructField(name, dtype, True, meta)


#: Images are raw bytes in height, width, channel order; their shape is column metadata.
FRAME_SCHEMA = T.StructType(
    [
        _field("episode_index", T.LongType()),
        _field("frame_index", T.LongType()),
        _field("timestamp", T.FloatType()),
        _field(STATE, T.ArrayType(T.FloatType()), [12], STATE_NAMES),
        _field("action", T.ArrayType(T.FloatType()), [6], ACTION_NAMES),
        _field(WRIST, T.BinaryType(), IMAGE_SHAPE),
        _field(OVERHEAD, T.BinaryType(), IMAGE_SHAPE),
    ]
)
