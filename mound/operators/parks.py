"""Park-fence lookup (J5): batted ball x fence segment of its park.

The fence table (a handful of rows per park) is written once, and Spark
broadcasts it by the size of its files: a map-side hash join on the park
plus a range condition on the spray angle, so the many batted balls of
one park meet no shuffle and no hot task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mound.session import write_through

FAIR_LEFT, FAIR_RIGHT = -45.0, 45.0


def fence_rows(fences: Mapping[str, Sequence[tuple[str, int]]]) -> list[tuple]:
    """Give each listed segment an equal share of fair territory, from the
    left-field foul line (-45 degrees) to the right-field line (+45)."""
    rows = []
    for park, segs in fences.items():
        width = (FAIR_RIGHT - FAIR_LEFT) / len(segs)
        for i, (name, dist) in enumerate(segs):
            lo = FAIR_LEFT + i * width
            rows.append((park, i + 1, name, lo, lo + width, float(dist)))
    return rows


def fence_frame(spark: SparkSession, fences: Mapping[str, Sequence[tuple[str, int]]]) -> DataFrame:
    return spark.createDataFrame(
        fence_rows(fences),
        "park string, segment_no int, segment string, angle_lo double, angle_hi double, fence_ft double",
    )


#: Both poles are fair: the last segment includes its upper edge.
FOUL_POLE = 45.0


def fence_check(batted: DataFrame, fences: DataFrame, park: str = "park", angle: str = "spray_angle",
                distance: str = "distance_ft") -> DataFrame:
    """Left join each batted ball to the fence segment in its direction;
    ``over_fence`` is true when the ball travels past that segment's
    distance, false when short of it, null outside fair territory or for
    an undescribed park."""
    f = write_through(fences.withColumnRenamed("park", "__park"), "park-fences")
    cond = (
        (batted[park] == f["__park"])
        & (batted[angle] >= f["angle_lo"])
        & ((batted[angle] < f["angle_hi"]) | ((batted[angle] == FOUL_POLE) & (f["angle_hi"] == FOUL_POLE)))
    )
    j = batted.join(f, cond, "left")
    return j.withColumn("over_fence", F.col(distance) > F.col("fence_ft")).drop("__park", "angle_lo", "angle_hi")
