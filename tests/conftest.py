import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import compare  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return compare.session()


@pytest.fixture(scope="session")
def duck():
    return compare.database(SF)


@pytest.fixture
def sf():
    return SF


@pytest.fixture
def make_frames(spark):
    """Frames from {episode: [action vector, ...]}; the state is the action plus 100."""

    def build(episodes):
        rows = [
            (e, i, [float(v) for v in a], [float(v) + 100 for v in a])
            for e, actions in episodes.items()
            for i, a in enumerate(actions)
        ]
        return spark.createDataFrame(rows, "episode_index long, frame_index long, action array<double>, state array<double>").repartition(5)

    return build
