"""Point-in-polygon join.

Zones are cut into grid cells once; each cell keeps only the zone edges that can matter to a point
in it. Cells are as large as suits the zone: their side is a power of four that cuts the zone's longer
side into at most MOST_SPLITS, so a zone touches a bounded number of cells whatever the sizes of others.
Points find their cell by arithmetic, once for each cell size in use, so the join is an equality join
followed by an even-odd test over a handful of edges. Few cut zones, as counted, are broadcast and the
points never move; many are joined by shuffle with a salt.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylode.functions import geometry as geo
from citylode.session import scratch_path

MOST_SPLITS = 4
LEVELS = (-14, 6)  # exponents of four: cells from 4e-9 to 4096 degrees
MAX_BROADCAST_CELLS = 400_000
MAX_BROADCAST_EDGES = 1_000_000
SALT = 16
NOWHERE = -(2 ** 62)


def with_edges(zones: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Add the edge list and bounding box of the GeoJSON text; zones without edges are dropped."""
    cut = zones.withColumn("edges", geo.edges(F.col(geometry))).filter(F.size("edges") > 0)
    return cut.select("*", *geo.extent(F.col("edges")))


def cut_zones(zones: DataFrame, keep: list[str]) -> DataFrame:
    """One row per zone and cell its box touches, with the edges relevant inside that cell.

    A box touches at most (MOST_SPLITS + 2) cells each way, so a zone of n edges gives at most
    (MOST_SPLITS + 2) squared * n edges, one cell at a time.

    Relevant edges overlap the cell's vertical span and do not lie wholly left of it; all others
    cannot be crossed by a ray going right from a point in the cell. Cells left without edges are
    outside the zone. A small margin absorbs rounding at cell borders.
    """
    side = F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y")) / MOST_SPLITS
    level = F.ceil(F.log(4.0, F.greatest(side, F.lit(4.0 ** LEVELS[0]))))
    zones = zones.withColumn("level", F.least(F.greatest(level, F.lit(LEVELS[0])), F.lit(LEVELS[1])).cast("int"))
    cell = F.pow(F.lit(4.0), F.col("level"))
    margin = cell * 1e-6

    def span(low: str, high: str):
        return F.explode(F.sequence(F.floor(F.col(low) / cell), F.floor(F.col(high) / cell)))

    cells = (
        zones.select(*keep, "edges", "level", "min_y", "max_y", span("min_x", "max_x").alias("cell_x"))
        .select(*keep, "edges", "level", "cell_x", span("min_y", "max_y").alias("cell_y"))
    )
    left = F.col("cell_x") * cell - margin
    bottom = F.col("cell_y") * cell - margin
    top = (F.col("cell_y") + 1) * cell + margin

    def relevant(edge):
        return (
            (F.greatest(edge["x1"], edge["x2"]) >= left)
            & (F.greatest(edge["y1"], edge["y2"]) >= bottom)
            & (F.least(edge["y1"], edge["y2"]) <= top)
        )

    return (
        cells.withColumn("edges", F.filter("edges", relevant))
        .filter(F.size("edges") > 0)
    )


@dataclass(frozen=True)
class ZoneIndex:
    """Cut zones, stored, ready to be joined to any number of point tables."""
    cells: DataFrame
    levels: tuple[int, ...]
    columns: tuple[str, ...]
    broadcast: bool


def index_zones(
    zones: DataFrame, geometry: str = "geometry",
    keep: tuple[str, ...] = ("arrondissement_code", "nom_arrondissement"), strategy: str = "auto",
) -> ZoneIndex:
    """Cut zones with a GeoJSON column; ``keep`` are the columns a join attaches to a point.

    The cut cells are stored in the shared scratch folder and counted there. ``strategy`` is auto (broadcast
    if cells and edges are few), broadcast or shuffle.
    """
    if strategy not in ("auto", "broadcast", "shuffle"):
        raise ValueError(f"unknown strategy {strategy!r}")
    shaped = with_edges(zones, geometry).select(
        *keep, "edges", "min_x", "min_y", "max_x", "max_y")
    cut, path = cut_zones(shaped, list(keep)), scratch_path(zones.sparkSession, "zone-cells")
    cut.write.parquet(path)
    cells = zones.sparkSession.read.schema(cut.schema).parquet(path)
    count, edges, levels = cells.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.size("edges")), F.lit(0)), F.collect_set("level")).first()
    fits = count <= MAX_BROADCAST_CELLS and edges <= MAX_BROADCAST_EDGES
    small = strategy == "broadcast" or (strategy == "auto" and fits)
    return ZoneIndex(cells, tuple(sorted(levels)), tuple(keep), small)


def spatial_join(
    points: DataFrame, index: ZoneIndex, x: str = "longitude", y: str = "latitude",
) -> DataFrame:
    """Inner join of points to the zone that holds them.

    Points outside every zone, or without coordinates, are dropped; the latter before a shuffle.
    """
    if not index.broadcast:
        points = points.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    levels = F.array(*[F.lit(level) for level in index.levels] or [F.lit(LEVELS[0])])
    size = F.pow(F.lit(4.0), F.col("level"))

    # Missing coordinates get a cell far from every zone instead of NULL. A nullable join key would
    # make Spark add "is not null" tests on the coordinates and push them down to the scan, where
    # coordinates still are text and would be parsed once more per test.
    def cell(coordinate: str):
        return F.coalesce(F.floor(F.col(coordinate) / size), F.lit(NOWHERE))

    placed = points.select("*", F.explode(levels).alias("level")).select(
        "*", cell(x).alias("cell_x"), cell(y).alias("cell_y"))
    on, cells = ["level", "cell_x", "cell_y"], index.cells
    if index.broadcast:
        cells = F.broadcast(cells)
    else:
        # A hot cell is spread over SALT reducers: points are salted by their values and the split
        # they come from (copies in different splits part too, and a retried task salts alike); the
        # much smaller cell rows are repeated once per salt.
        plain = [c for c, kind in points.dtypes if not kind.startswith(("map", "variant"))]
        mixed = F.xxhash64(F.spark_partition_id(), *plain)
        placed = placed.withColumn("salt_", F.pmod(mixed, F.lit(SALT)).cast("int"))
        cells = cells.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))).hint("shuffle_hash")
        on = on + ["salt_"]
    matched = placed.join(cells, on, "inner").filter(geo.inside(F.col("edges"), F.col(x), F.col(y)))
    return matched.drop("edges", *on)
