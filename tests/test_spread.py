"""Tables that grow after they are read: no join of theirs is planned by the size of the file, and partitions follow the rows."""

import os

import pytest
from pyspark.sql import functions as F

from partloom import registry
from partloom.operators import pixels
from partloom.operators.spread import PARTITION_ROWS, spread

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.exists(SF), reason="no tables")
@pytest.mark.parametrize("name", ["a13_texture_metrics", "a13_texture_score", "a14_edge_f1", "a14_silhouette_score", "a18_largest_blobs", "a18_verify_boxes", "a19_recover_regions", "a21_project_groups", "x01_registered_score",
    "g03_coherent_regions", "g04_loose_and_pieces", "g05_mesh_metrics", "g06_region_metrics", "g07_signed_volume", "g09_geometry_digest", "g01_connected_components"])
def test_exploded_tables_are_not_broadcast(spark, name):
    assert "Broadcast" not in plan(registry.queries()[name](spark, SF))


def test_partitions_follow_the_rows_to_come(spark):
    df = spark.range(10_000).withColumnRenamed("id", "k")
    dealt = spread(df, ["k"], 1000)
    assert dealt.rdd.getNumPartitions() == max(spark.sparkContext.defaultParallelism, -(-10_000_000 // PARTITION_ROWS))
    assert dealt.groupBy("k").count().agg(F.sum("count")).first()[0] == 10_000


def test_blobs_of_winding_shapes(spark):
    """A spiral of 25 x 25 takes more turns than pixels are swept: its pieces are joined as a graph."""
    n, cells, x, y, dx, dy = 25, set(), 0, 0, 1, 0
    cells.add((0, 0))
    while True:
        for _ in range(2):
            ahead, two = (x + dx, y + dy), (x + 2 * dx, y + 2 * dy)
            if not (0 <= ahead[0] < n and 0 <= ahead[1] < n) or two in cells or ahead in cells:
                dx, dy = -dy, dx
        ahead, two = (x + dx, y + dy), (x + 2 * dx, y + 2 * dy)
        if not (0 <= ahead[0] < n and 0 <= ahead[1] < n) or two in cells or ahead in cells:
            break
        x, y = ahead
        cells.add(ahead)
    df = spark.createDataFrame([(1, a, b) for a, b in cells] + [(2, a, b) for a, b in cells if a < 12], "k long, x long, y long")
    got = pixels.blobs(df, "k").where("k = 1").collect()
    assert [(r.pixels, r.x0, r.y0) for r in got] == [(len(cells), 0, 0)]

    left, sizes = {c for c in cells if c[0] < 12}, []
    while left:
        queue, size = [left.pop()], 0
        while queue:
            a, b = queue.pop()
            size += 1
            for near in ((a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)):
                if near in left:
                    left.remove(near)
                    queue.append(near)
        sizes.append(size)
    assert sorted(r.pixels for r in pixels.blobs(df, "k").where("k = 2").collect()) == sorted(sizes)
