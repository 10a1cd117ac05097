import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from mound.session import local_session

    s = local_session("*", shuffle_partitions=8)
    yield s
    s.stop()


PITCH_COLS = ("game_date string, game_pk long, pitch_number long, pitcher long, home_team string, "
              "away_team string, inning_topbot string, events string, description string, type string, "
              "pitch_type string, release_speed double, release_spin_rate double, launch_speed double, "
              "launch_angle double, home_score long, away_score long")


def pitch(date, pk, n, home, away, half, events=None, desc="ball", typ="B", speed=90.0, spin=2000.0,
          ls=None, la=None, hs=0, as_=0, pitcher=1, ptype="FF"):
    return (date, pk, n, pitcher, home, away, half, events, desc, typ, ptype, speed, spin, ls, la, hs, as_)


@pytest.fixture
def make_pitches(spark):
    def make(rows):
        return spark.createDataFrame(rows, PITCH_COLS)
    return make
