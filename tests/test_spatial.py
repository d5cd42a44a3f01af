import json
import random

import pytest
from conftest import one, plan_of, rows

from wardline.operators import spatial
from wardline.sources.tables import load_polygons, read_polygon_file


def square(x, y, w=4.0, h=4.0):
    return [[x, y], [x + w, y], [x + w, y + h], [x, y + h], [x, y]]


SHAPES = {
    "10001": {"type": "Polygon", "coordinates": [square(0, 0), square(1, 1, 1, 1)]},
    "10002": {"type": "Polygon", "coordinates": [square(4, 0)]},
    "10003": {"type": "Polygon", "coordinates": [square(6, 0)]},
    "10004": {"type": "MultiPolygon", "coordinates": [[square(20, 20, 1, 1)], [square(30, 30, 2, 2)]]},
}


@pytest.fixture(scope="module")
def polygons(spark):
    features = spark.createDataFrame(
        [(z, json.dumps(g)) for z, g in SHAPES.items()] + [(" ", json.dumps(SHAPES["10002"]))],
        "zip string, geo string",
    )
    return spatial.polygon_table(features, "zip", "geo")


POINTS = [
    (1, 0.5, 0.5, "10001"),
    (2, 1.5, 1.5, None),  # in the hole
    (3, 4.0, 2.0, "10002"),  # on the shared border: one side only
    (4, 7.0, 1.0, "10002"),  # overlap: lowest zip
    (5, 9.0, 1.0, "10003"),
    (6, 31.0, 31.0, "10004"),
    (7, 50.0, 50.0, None),
    (8, float("nan"), 1.0, None),
    (9, None, None, None),
]


@pytest.mark.parametrize("cell", [0.3, 1.0, 10.0])
@pytest.mark.parametrize("limit", [spatial.BROADCAST_LIMIT_BYTES, 0])
def test_points(spark, polygons, cell, limit):
    points = spark.createDataFrame(
        [(i, x, y) for i, x, y, _ in POINTS], "id int, longitude double, latitude double"
    )
    placed = spatial.assign_zip(points, polygons, cell=cell, broadcast_limit=limit)
    expected = sorted(
        (i, z or "UNKNOWN", "spatial" if z else "borough_fallback") for i, _, _, z in POINTS
    )
    assert rows(placed, "id", "zip_code", "zip_code_source") == expected


def brute(x, y):
    for zip_code in sorted(SHAPES):
        g = SHAPES[zip_code]
        rings = g["coordinates"] if g["type"] == "Polygon" else [r for p in g["coordinates"] for r in p]
        crossings = 0
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
                if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                    crossings += 1
        if crossings % 2:
            return zip_code
    return "UNKNOWN"


def test_random_points_match_brute_force(spark, polygons):
    rng = random.Random(3)
    data = [(i, rng.uniform(-1, 34), rng.uniform(-1, 34)) for i in range(300)]
    data += [(300 + i, rng.randrange(0, 12) / 1.0, rng.randrange(0, 6) / 1.0) for i in range(200)]
    points = spark.createDataFrame(data, "id int, longitude double, latitude double")
    expected = sorted(((i, brute(x, y)) for i, x, y in data), key=repr)
    for cell, limit in ((0.7, spatial.BROADCAST_LIMIT_BYTES), (2.5, 0)):
        placed = spatial.assign_zip(points, polygons, cell=cell, broadcast_limit=limit)
        assert rows(placed, "id", "zip_code") == expected


@pytest.mark.parametrize("limit", [spatial.BROADCAST_LIMIT_BYTES, 0])
def test_null_and_repeated_ids_keep_their_own_zip(spark, polygons, limit):
    points = spark.createDataFrame(
        [(None, 0.5, 0.5), (7, 0.5, 0.5), (7, 9.0, 1.0), (8, 50.0, 50.0), (None, 9.0, 1.0)],
        "id int, longitude double, latitude double",
    )
    placed = spatial.assign_zip(points, polygons, cell=1.0, broadcast_limit=limit)
    assert rows(placed, "id", "longitude", "zip_code") == sorted(
        [(None, 0.5, "10001"), (7, 0.5, "10001"), (7, 9.0, "10003"), (8, 50.0, "UNKNOWN"), (None, 9.0, "10003")],
        key=repr,
    )


def test_small_cover_never_shuffles_points(spark, polygons):
    points = spark.createDataFrame([(1, 1.0, 1.0)], "id int, longitude double, latitude double")
    plan = plan_of(spatial.assign_zip(points, polygons, cell=1.0))
    assert "BroadcastHashJoin" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SortMergeJoin" not in plan


@pytest.mark.parametrize("layout", ["collection", "records"])
def test_polygon_file_layouts(spark, folder, layout):
    if layout == "collection":
        body = {
            "type": "FeatureCollection",
            "features": [
                {"type": "Feature", "properties": {"modzcta": z}, "geometry": g} for z, g in SHAPES.items()
            ]
            + [{"type": "Feature", "properties": {"modzcta": ""}, "geometry": SHAPES["10001"]}],
        }
    else:
        body = [{"modzcta": z, "the_geom": g} for z, g in SHAPES.items()] + [{"the_geom": SHAPES["10001"]}]
    path = f"{folder}/zips.geojson"
    with open(path, "w") as out:
        json.dump(body, out)
    table = read_polygon_file(spark, path)
    assert [r[0] for r in rows(table, "zip_code")] == sorted(SHAPES)
    assert table.filter("size(edges) = 0 or edges is null").count() == 0


def test_polygon_table_is_loaded_once(spark, folder):
    def write(shapes):
        with open(f"{folder}/zips.geojson", "w") as out:
            json.dump([{"modzcta": z, "the_geom": shapes[z]} for z in shapes], out)

    write({"10001": SHAPES["10001"]})
    load_polygons(spark, f"{folder}/zips.geojson", f"{folder}/table")
    write(SHAPES)
    assert load_polygons(spark, f"{folder}/zips.geojson", f"{folder}/table").count() == 1
    assert load_polygons(spark, f"{folder}/zips.geojson", f"{folder}/table", refresh=True).count() == 4
    write({"1": {"type": "Point", "coordinates": [1, 2]}})
    with pytest.raises(ValueError, match="could not be parsed"):
        load_polygons(spark, f"{folder}/zips.geojson", f"{folder}/other")


def test_no_polygon_table(spark):
    points = spark.createDataFrame([(1, 1.0, 1.0)], "id int, longitude double, latitude double")
    assert one(spatial.assign_zip(points, None), "zip_code") == ("UNKNOWN",)


def test_cover_follows_the_border(spark):
    """A large polygon with a hole: rows grow with its border, and points fall as by brute force."""
    ring = lambda a, b: [[a, a], [b, a], [b + 0.3, (a + b) / 2], [b, b], [a, b], [a, a]]
    shape = json.dumps({"type": "Polygon", "coordinates": [ring(0.2, 9.7), ring(3.1, 5.2)]})
    other = json.dumps({"type": "Polygon", "coordinates": [[[1, 1], [2.5, 1.2], [2, 2.4], [1, 1]]]})
    polygons = spatial.polygon_table(
        spark.createDataFrame([("b", shape), ("a", other)], "z string, g string"), "z", "g"
    ).cache()
    sizes = {}
    for cell in (0.02, 0.01):
        cover = spatial.cell_cover(polygons, cell)
        sizes[cell] = cover.count()
        assert cover.filter("whole AND edges IS NOT NULL").count() == 0
        area = int(9.5 / cell) ** 2
        assert sizes[cell] < area / 4
    assert sizes[0.01] < 2.6 * sizes[0.02]
    rnd = random.Random(4)
    data = [(i, rnd.uniform(-1, 11), rnd.uniform(-1, 11)) for i in range(3000)]
    data += [(3000 + i, round(rnd.uniform(0, 10) / 0.16) * 0.16, rnd.choice([0.2, 1.6, 3.1, 9.7])) for i in range(200)]
    points = spark.createDataFrame(data, "id int, longitude double, latitude double")
    edges = {r.zip_code: r.edges for r in polygons.collect()}

    def within(e, x, y):
        crossed = [a for a in e if a.y1 != a.y2 and (a.y1 > y) != (a.y2 > y) and x < (a.x2 - a.x1) * (y - a.y1) / (a.y2 - a.y1) + a.x1]
        return len(crossed) % 2 == 1

    for limit in (spatial.BROADCAST_LIMIT_BYTES, 0):
        got = {r.id: r.zip_code for r in spatial.assign_zip(points, polygons, cell=0.02, broadcast_limit=limit).collect()}
        assert len(got) == len(data)
        for i, x, y in data:
            hits = [z for z, e in edges.items() if within(e, x, y)]
            assert got[i] == (min(hits) if hits else "UNKNOWN"), (i, x, y)


def test_wide_cells_of_every_width(spark, polygons):
    """A polygon of some thousand cells each way: few rows, whole cells of all widths, right zips."""
    far = {"type": "Polygon", "coordinates": [[[0, 0], [30, 1], [29, 28], [2, 30], [0, 0]], square(10, 10, 8, 8)]}
    features = spark.createDataFrame([("1", json.dumps(far)), ("2", json.dumps(SHAPES["10001"]))], "zip string, geo string")
    table = spatial.polygon_table(features, "zip", "geo")
    cover = spatial.cell_cover(table, 0.01)
    counts = {(r.width, r.whole): r["count"] for r in cover.groupBy("width", "whole").count().collect()}
    assert {w for w, whole in counts if whole} == set(spatial.WIDTHS) and {w for w, whole in counts if not whole} == {1}
    # The border is about 160 wide, 16,000 small cells; the area about 7 million.
    assert sum(counts.values()) < 120_000
    rng = random.Random(4)
    data = [(i, rng.uniform(-1, 31), rng.uniform(-1, 31)) for i in range(400)]
    rings = {"1": far["coordinates"], "2": SHAPES["10001"]["coordinates"]}

    def within(x, y):
        for zip_code, parts in rings.items():
            ends = [(a, b) for ring in parts for a, b in zip(ring, ring[1:])]
            if sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in ends) % 2:
                return zip_code
        return "UNKNOWN"

    points = spark.createDataFrame(data, "id int, longitude double, latitude double")
    expected = sorted(((i, within(x, y)) for i, x, y in data), key=repr)
    for limit in (spatial.BROADCAST_LIMIT_BYTES, 0):
        assert rows(spatial.assign_zip(points, table, cell=0.01, broadcast_limit=limit), "id", "zip_code") == expected
