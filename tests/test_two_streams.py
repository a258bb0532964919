"""The comparisons of two streams cover every site."""

import pytest
from pyspark.sql import functions as F

from motionframes.operators import rotations
from workloads import cluster_queries as queries
from workloads.base import SITES, large_frames, small_frames

FOLDER = "/root/testdata/sf0.001"


def streams(spark, site, joint):
    """One site alone."""
    small = small_frames(spark, FOLDER).where(F.col("site") == site).select("take", "frame", F.col("q").alias("a"))
    return small.join(large_frames(spark, FOLDER).where(F.col("joint") == joint).select("take", "frame", F.col("g").alias("b")), ["take", "frame"])


def test_every_frame_of_every_site_is_compared(spark):
    found = queries.two_streams(spark, FOLDER).groupBy("site").count().collect()
    assert {r["site"]: r["count"] for r in found} == {site: streams(spark, site, joint).count() for site, joint in SITES}


def test_each_site_compares_as_it_would_alone(spark):
    found = {(r["take"], r["site"]): r for r in queries.a16_compare_orientation(spark, FOLDER).collect()}
    mounts = {r["site"] for r in queries.a15_mounting_rotation(spark, FOLDER).collect()}
    gaps = {r["site"] for r in queries.j19_two_stream_gaps(spark, FOLDER).collect()}
    assert mounts == gaps == {site for site, _ in SITES}
    for site, joint in SITES:
        alone = rotations.compare_orientation(streams(spark, site, joint), keys=["take"], frame="frame", a="a", b="b", dt_s=0.01, min_rate=1.0).collect()
        assert len(alone) == sum(s == site for _, s in found)
        for r in alone:
            here = found[r["take"], site]
            assert here["frames"] == r["frames"]
            assert (here["median_deg"], here["max_deg"]) == pytest.approx((r["median_deg"], r["max_deg"]), abs=1e-3)
