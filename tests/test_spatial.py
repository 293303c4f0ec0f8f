import json
import math

import pytest
from conftest import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citylode.operators.spatial import MOST_SPLITS, index_zones, spatial_join


def polygon(*rings):
    return json.dumps({"type": "Polygon", "coordinates": [list(map(list, r)) for r in rings]})


def box(x1, y1, x2, y2):
    return [(x1, y1), (x2, y1), (x2, y2), (x1, y2), (x1, y1)]


def diamond(cx, cy, r=0.5):
    return [(cx, cy - r), (cx + r, cy), (cx, cy + r), (cx - r, cy), (cx, cy - r)]


def zones(spark, *shapes):
    data = [(i, f"zone {i}", g) for i, g in enumerate(shapes)]
    return spark.createDataFrame(data, "arrondissement_code int, nom_arrondissement string, geometry string")


def points(spark, places):
    data = [(i, *[None if v is None else float(v) for v in place]) for i, place in enumerate(places)]
    return spark.createDataFrame(data, "id int, longitude double, latitude double")


def found(spark, places, shapes, strategy="auto"):
    joined = spatial_join(points(spark, places), index_zones(zones(spark, *shapes), strategy=strategy))
    out = {}
    for r in joined.collect():
        out.setdefault(r["id"], []).append(r["arrondissement_code"])
    return out


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_hole_and_multipolygon(spark, strategy):
    ring = polygon(box(0, 0, 10, 10), box(4, 4, 6, 6))
    islands = json.dumps({"type": "MultiPolygon", "coordinates": [
        [list(map(list, box(20, 0, 21, 1)))], [list(map(list, box(30, 0, 31, 1)))]]})
    got = found(spark, [(1, 1), (5, 5), (20.5, .5), (30.5, .5), (25, .5)], [ring, islands], strategy)
    assert got == {0: [0], 2: [1], 3: [1]}


def test_shared_edge_belongs_to_exactly_one_zone(spark):
    shapes = [polygon(box(0, 0, 1, 1)), polygon(box(1, 0, 2, 1)), polygon(box(0, 1, 1, 2))]
    got = found(spark, [(1, .5), (.5, 1), (1, 0), (0, 0), (2, .5)], shapes)
    assert got == {0: [1], 1: [2], 2: [1], 3: [0]}


def test_missing_and_outside_points_are_dropped(spark):
    shapes = [polygon(box(0, 0, 1, 1))]
    assert found(spark, [(None, .5), (.5, None), (9, 9), (float("nan"), .5), (.5, .5)], shapes) == {4: [0]}


def test_other_geometries_and_empty_zone_tables(spark):
    line = json.dumps({"type": "LineString", "coordinates": [[0, 0], [1, 1]]})
    assert found(spark, [(.5, .5)], [line]) == {}
    assert found(spark, [(.5, .5)], [line, polygon(box(0, 0, 1, 1))]) == {0: [1]}


def test_cell_count_is_bounded_for_mixed_sizes(spark):
    shapes = [polygon(box(0, 0, 1000, 800))] + [polygon(diamond(i + .5, .5, .01)) for i in range(40)]
    index = index_zones(zones(spark, *shapes))
    assert index.cells.count() <= (MOST_SPLITS + 2) ** 2 * len(shapes)
    assert index.broadcast


def test_many_zones_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr("citylode.operators.spatial.MAX_BROADCAST_CELLS", 10)
    assert not index_zones(zones(spark, polygon(box(0, 0, 1, 1)))).broadcast


def test_one_large_zone_of_many_edges_among_many_small_ones(spark):
    """The cells of the large zone do not depend on how many small ones there are."""
    n = 8_000
    ring = [(50 + 60 * math.cos(2 * math.pi * k / n), 20 + 60 * math.sin(2 * math.pi * k / n)) for k in range(n)]
    small = [polygon(diamond(i % 100 + .5, i // 100 + .5, .01)) for i in range(2_000)]
    index = index_zones(zones(spark, polygon(ring + ring[:1]), *small))
    assert index.cells.filter("arrondissement_code = 0").count() <= (MOST_SPLITS + 2) ** 2
    places = [(50, 20), (50, 79.9), (50, 80.1), (.5, .5), (99.5, 19.5)]
    got = {}
    for r in spatial_join(points(spark, places), index).collect():
        got.setdefault(r["id"], set()).add(r["arrondissement_code"])
    assert got == {0: {0}, 1: {0}, 3: {0, 1}, 4: {0, 2000}}


def test_broadcast_keeps_points_in_place(spark, tmp_path):
    path = str(tmp_path / "points")
    points(spark, [(.5, .5)]).write.parquet(path)
    index = index_zones(zones(spark, polygon(box(0, 0, 1, 1))))
    plan = plan_of(spatial_join(spark.read.parquet(path), index))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


coordinate = st.floats(-1, 6, allow_nan=False).map(lambda v: round(v, 4))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(coordinate, coordinate), min_size=50, max_size=200))
def test_both_strategies_match_the_closed_form(spark, places):
    centres = [(i % 5 + .5, i // 5 + .5) for i in range(25)]
    places = [p for p in places if all(abs(abs(p[0] - x) + abs(p[1] - y) - .5) > 1e-9 for x, y in centres)]
    shapes = [polygon(diamond(x, y)) for x, y in centres]
    want = {}
    for i, (x, y) in enumerate(places):
        hits = [k for k, (cx, cy) in enumerate(centres) if abs(x - cx) + abs(y - cy) < .5]
        if hits:
            want[i] = hits
    assert found(spark, places, shapes, "broadcast") == want
    assert found(spark, places, shapes, "shuffle") == want


def test_rough_polygons_match_brute_force(spark):
    """Star shapes with many edges, tested against the textbook even-odd loop."""
    def star(cx, cy, n=40):
        ring = [(cx + (1 + .6 * (k % 2)) * math.cos(2 * math.pi * k / n),
                 cy + (1 + .6 * (k % 2)) * math.sin(2 * math.pi * k / n)) for k in range(n)]
        return ring + ring[:1]

    rings = [star(0, 0), star(3.5, 0), star(0, 3.5)]
    places = [(i * .137 % 6 - 1.7, i * .291 % 6 - 1.7) for i in range(600)]

    def holds(ring, x, y):
        odd = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
        return odd

    want = {i: [k for k, r in enumerate(rings) if holds(r, *p)] for i, p in enumerate(places)}
    got = found(spark, places, [polygon(r) for r in rings])
    assert {i: sorted(z) for i, z in got.items()} == {i: z for i, z in want.items() if z}


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        index_zones(zones(spark), strategy="guess")


def test_shuffle_path_keeps_every_copy_of_a_hot_point(spark):
    many = spark.range(9_000).select(
        F.col("id"), F.lit(.5).alias("longitude"), F.lit(.5).alias("latitude"))
    index = index_zones(zones(spark, polygon(box(0, 0, 1, 1))), strategy="shuffle")
    joined = spatial_join(many, index)
    plan = plan_of(joined)
    assert "Exchange hashpartitioning" in plan and "Broadcast" not in plan
    assert joined.count() == joined.select("id").distinct().count() == 9_000
