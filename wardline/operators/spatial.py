"""Point-in-polygon assignment from built-in expressions only.

Polygons become edge lists, and these are cut by a quadtree of grid cells: cells without any
border lie inside as a whole and need no edges; only those the border passes are cut into smaller
ones. Each point looks up the rows of its cells. Inside the cell's candidates an even-odd count of
crossed edges decides; counting over all rings at once takes care of holes and of several parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.fixed_values import ZIP_FALLBACK, ZIP_FROM_POLYGON, ZIP_UNKNOWN

# Spark holds a broadcast side in every executor; beyond this the cells are shuffled instead.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
BYTES_PER_EDGE = 64
# Widths of the cover's cells in small cells, each a multiple of the next.
WIDTHS = (512, 64, 8, 1)
BYTES_PER_CANDIDATE = 128

POLYGON = "array<array<array<double>>>"
MULTI_POLYGON = "array<array<array<array<double>>>>"


def geojson_edges(geometry: Column) -> Column:
    """Edges of a GeoJSON Polygon or MultiPolygon text; NULL for anything else.

    Level edges never cross a horizontal ray, but they are border all the same.
    """
    kind = F.get_json_object(geometry, "$.type")
    body = F.get_json_object(geometry, "$.coordinates")
    rings = F.when(kind == "Polygon", F.from_json(body, POLYGON)).when(
        kind == "MultiPolygon", F.flatten(F.from_json(body, MULTI_POLYGON))
    )

    def ring_edges(ring: Column) -> Column:
        following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
        return F.zip_with(
            ring,
            following,
            lambda a, b: F.struct(
                a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2")
            ),
        )

    edges = F.flatten(F.transform(rings, ring_edges))
    return F.filter(edges, lambda e: (e.x1 != e.x2) | (e.y1 != e.y2))


def polygon_table(features: DataFrame, zip_code: str, geometry: str) -> DataFrame:
    """Features with GeoJSON text -> (zip_code, edges); blank zips are skipped."""
    return features.select(
        F.trim(F.col(zip_code)).alias("zip_code"), geojson_edges(F.col(geometry)).alias("edges")
    ).filter(F.col("zip_code") != "")


def cell_cover(polygons: DataFrame, cell: float, widths: Sequence[int] = WIDTHS) -> DataFrame:
    """(zip_code, width, cell_x, cell_y, whole, edges): the cells a polygon may hold points of.

    The bounding box is laid out in the widest cells. One that no edge comes near is inside or
    outside as a whole, as its middle tells; the others are cut into cells of the next width, and
    so on down to width 1. So rows follow the length of the border and not the area. Whole cells
    carry no edges. Cells on the border keep only the edges that matter: a ray runs toward larger
    x, so those whose y-range meets the cell's and that do not lie wholly to the left. The slack
    keeps edges on a cell border. It is one chain of narrow steps without a shuffle.
    """
    slack = cell * 1e-6
    fresh = ~F.col("whole")

    def low(*names: str) -> Column:
        return F.array_min(F.transform("edges", lambda e: F.least(*[e[n] for n in names])))

    def high(*names: str) -> Column:
        return F.array_max(F.transform("edges", lambda e: F.greatest(*[e[n] for n in names])))

    def judged(cells: DataFrame, width: int) -> DataFrame:
        """Of the cells not known to be whole those outside go; the rest are whole or on the border."""
        left, bottom = F.col("cell_x") * width * cell, F.col("cell_y") * width * cell
        right, top = left + width * cell, bottom + width * cell
        x, y, half = (left + right) / 2, (bottom + top) / 2, width * cell / 2 + slack

        def matters(e: Column) -> Column:
            meets = (F.greatest(e.y1, e.y2) >= bottom - slack) & (F.least(e.y1, e.y2) <= top + slack)
            return meets & (F.greatest(e.x1, e.x2) >= left - slack)

        def passes(e: Column) -> Column:
            """The edge meets the cell: their boxes do, and the cell is not all on one side of it."""
            dx, dy = e.x2 - e.x1, e.y2 - e.y1
            near = F.abs(dx * (y - e.y1) - dy * (x - e.x1)) <= (F.abs(dx) + F.abs(dy)) * half
            return (F.least(e.x1, e.x2) <= right + slack) & near

        cut = cells.withColumn("edges", F.when(fresh, F.filter("edges", matters)))
        cut = cut.filter(F.col("whole") | (F.size("edges") > 0))
        cut = cut.withColumn("_border", F.coalesce(F.when(fresh, F.exists("edges", passes)), F.lit(False)))
        middle = F.when(fresh, inside(F.col("edges"), x, y)).otherwise(True)
        return cut.withColumn("whole", ~F.col("_border") & middle).filter("_border OR whole").drop("_border")

    def split(cells: DataFrame, parent: int, width: int) -> DataFrame:
        """Cells on the border in cells of `width`, within the bounding box; whole ones as they are."""

        def parts(axis: str) -> Column:
            first, times = F.col(f"cell_{axis}") * (parent // width), parent // width
            begin = F.greatest(first, F.floor(F.col(f"_{axis}0") / (width * cell)))
            end = F.least(first + times - 1, F.floor(F.col(f"_{axis}1") / (width * cell)))
            return F.explode(F.when(fresh, F.sequence(begin, end)).otherwise(F.array(f"cell_{axis}")))

        rest = [c for c in cells.columns if c not in ("cell_x", "cell_y")]
        cells = cells.select(*rest, "cell_y", parts("x").alias("cell_x")).select(*rest, "cell_x", parts("y").alias("cell_y"))
        return cells.withColumn("width", F.when(fresh, width).otherwise(F.col("width")))

    def span(axis: str) -> Column:
        size = widths[0] * cell
        return F.explode(F.sequence(F.floor(F.col(f"_{axis}0") / size), F.floor(F.col(f"_{axis}1") / size)))

    boxed = polygons.filter(F.size("edges") > 0).select(
        "zip_code", "edges", F.lit(False).alias("whole"), F.lit(widths[0]).alias("width"),
        low("x1", "x2").alias("_x0"), high("x1", "x2").alias("_x1"), low("y1", "y2").alias("_y0"), high("y1", "y2").alias("_y1"),
    )
    cells = boxed.select("*", span("x").alias("cell_x")).select("*", span("y").alias("cell_y"))
    cells = judged(cells, widths[0])
    for parent, width in zip(widths, widths[1:]):
        cells = judged(split(cells, parent, width), width)
    needed = F.when(fresh, F.filter("edges", lambda e: e.y1 != e.y2))
    return cells.select("zip_code", "width", "cell_x", "cell_y", "whole", needed.alias("edges"))


def inside(edges: Column, x: Column, y: Column) -> Column:
    """Even-odd rule with half-open edges: a shared border belongs to one side."""
    crossed = F.filter(
        edges,
        lambda e: ((e.y1 > y) != (e.y2 > y))
        & (x < (e.x2 - e.x1) * (y - e.y1) / F.nullif(e.y2 - e.y1, F.lit(0.0)) + e.x1),
    )
    return F.size(crossed) % 2 == 1


def assign_zip(
    points: DataFrame,
    polygons: DataFrame | None,
    latitude: str = "latitude",
    longitude: str = "longitude",
    cell: float = 0.01,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Adds `zip_code` and `zip_code_source`; every point keeps exactly one row.

    Where polygons overlap the lowest zip wins. Points without coordinates or outside all
    polygons, and all points when there is no polygon table, get the fallback labels.

    Each cell of the cover is one row with its candidate polygons, so a point meets at most one
    row of each width, and keys play no part: null and repeated ids keep their own zips. The
    cover is measured first, width by width. What is small enough is broadcast, and points are
    then never shuffled; otherwise both sides are shuffled by cell, where adaptive execution
    splits cells with many points. The rows are the same either way.
    """
    if polygons is None:
        return _labelled(points.withColumn("_zip", F.lit(None).cast("string")))
    cover = cell_cover(polygons, cell)
    # One row per width.
    sizes = cover.groupBy("width").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size(F.coalesce("edges", F.array()))).alias("edges"))
    measured = {r["width"]: r["n"] * BYTES_PER_CANDIDATE + r["edges"] * BYTES_PER_EDGE for r in sizes.collect()}
    x, y = F.col(longitude), F.col(latitude)
    matched = points.withColumns(
        {"cell_x": F.floor(_number(x) / cell), "cell_y": F.floor(_number(y) / cell), "_zip": F.lit(None).cast("string")}
    )
    for width in WIDTHS:
        if width not in measured:
            continue
        # Candidates per cell come from the cover only, never from points.
        cells = cover.filter(F.col("width") == width).groupBy(F.col("cell_x").alias("_at_x"), F.col("cell_y").alias("_at_y"))
        if width > 1:
            cells, hit = cells.agg(F.min("zip_code").alias("_candidates")), F.col("_candidates")
        else:
            cells = cells.agg(F.collect_list(F.struct("zip_code", "whole", "edges")).alias("_candidates"))
            hits = F.filter("_candidates", lambda c: c.whole | inside(c.edges, x, y))
            hit = F.array_min(F.transform(hits, lambda c: c.zip_code))
        if measured[width] <= broadcast_limit:
            cells = F.broadcast(cells)
        at = {"_at_x": F.floor(F.col("cell_x") / width), "_at_y": F.floor(F.col("cell_y") / width)}
        matched = matched.withColumns(at).join(cells, ["_at_x", "_at_y"], "left")
        matched = matched.withColumn("_zip", F.least("_zip", hit)).drop("_at_x", "_at_y", "_candidates")
    return _labelled(matched.drop("cell_x", "cell_y"))


def _number(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def _labelled(df: DataFrame) -> DataFrame:
    return df.select(
        *[c for c in df.columns if c != "_zip"],
        F.coalesce("_zip", F.lit(ZIP_UNKNOWN)).alias("zip_code"),
        F.when(F.col("_zip").isNotNull(), ZIP_FROM_POLYGON)
        .otherwise(ZIP_FALLBACK)
        .alias("zip_code_source"),
    )
