"""Geo column expressions: great-circle distance, nearest city, spatial cells.

Everything here is a native Catalyst expression; no Python runs per row.
"""

from __future__ import annotations

import itertools
import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from citymarts.session import materialized, path_exists, shared_dir

# Mean Earth radius in km used by the distance formula.
EARTH_RADIUS_KM = 6371.0

def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def valid_coords(*cols) -> Column:
    """True when every coordinate is neither NULL nor NaN."""
    cond = F.lit(True)
    for c in cols:
        c = _col(c)
        cond = cond & c.isNotNull() & ~F.isnan(c)
    return cond


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km (haversine); NULL when any input is NULL/NaN.

    The argument of asin is clamped to 1 against rounding; the NULL/NaN guard
    comes first because ``least`` skips NULL and would turn it into 20,015 km.
    """
    lat1, lon1, lat2, lon2 = (_col(c) for c in (lat1, lon1, lat2, lon2))
    h = (F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
         * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2))
    d = F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))
    return F.when(valid_coords(lat1, lon1, lat2, lon2), d)


def unit_vector(lat, lon) -> tuple[Column, Column, Column]:
    """Point on the unit sphere; chord length is monotone in arc length."""
    phi, lam = F.radians(_col(lat)), F.radians(_col(lon))
    return F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)


def city_points(geo: DataFrame) -> DataFrame:
    """Dimension rows with their unit vectors."""
    x, y, z = unit_vector("lat", "lon")
    return (geo.where(valid_coords("lat", "lon"))
            .select("zone_id", "city", "tz", "lat", "lon",
                    x.alias("x"), y.alias("y"), z.alias("z")))


# Edge of the cells of the nearest-city index, in km.
DEFAULT_INDEX_CELL_KM = 250.0


def _box_dist2(c) -> tuple[Column, Column]:
    """Squared (min, max) distance from point struct ``c`` to the row's cell box."""
    mn, mx = F.lit(0.0), F.lit(0.0)
    for ax in ("x", "y", "z"):
        v, a, b = c[ax], F.col(f"_lo_{ax}"), F.col(f"_hi_{ax}")
        mn = mn + F.pow(F.greatest(a - v, F.lit(0.0), v - b), 2)
        mx = mx + F.pow(F.greatest(F.abs(v - a), F.abs(v - b)), 2)
    return mn, mx


def _shell_cells(spark, e: float) -> DataFrame:
    """All cells of edge ``e`` (unit sphere) that meet the sphere, with their bounds."""
    lo_i = int(math.floor(-1.0 / e)) - 1
    n = int(math.floor(1.0 / e)) - lo_i + 2
    g = spark.range(n ** 3).select(
        (F.col("id") % n + lo_i).alias("cx"),
        ((F.col("id") / n).cast("long") % n + lo_i).alias("cy"),
        ((F.col("id") / (n * n)).cast("long") + lo_i).alias("cz"))
    g = g.select("cx", "cy", "cz", *[
        (F.col(f"c{ax}") * e).alias(f"_lo_{ax}") for ax in "xyz"], *[
        ((F.col(f"c{ax}") + 1) * e).alias(f"_hi_{ax}") for ax in "xyz"])
    return g.where(_meets_sphere())


def _meets_sphere() -> Column:
    """Whether the row's cell box meets the unit sphere."""
    lo = [F.col(f"_lo_{ax}") for ax in "xyz"]
    hi = [F.col(f"_hi_{ax}") for ax in "xyz"]
    near2 = sum(F.pow(F.greatest(a, F.lit(0.0), -b), 2) for a, b in zip(lo, hi))
    far2 = sum(F.greatest(a * a, b * b) for a, b in zip(lo, hi))
    return (near2 <= 1.0 + 1e-9) & (far2 >= 1.0 - 1e-9)


def _candidates(pairs: DataFrame) -> DataFrame:
    """(cell, city) rows whose city can be nearest somewhere in the cell."""
    mn, mx = _box_dist2(F.col("c"))
    pairs = pairs.select("*", mn.alias("_mn"), mx.alias("_mx"))
    least = pairs.groupBy("cx", "cy", "cz").agg(F.min("_mx").alias("_u"))
    # a city's rows compress so well that their shuffled size would pass for one to broadcast
    return (pairs.hint("merge").join(least, ["cx", "cy", "cz"])
            .where(F.col("_mn") <= F.col("_u") * (1 + 1e-9) + 1e-15).drop("_mn", "_mx", "_u"))


# Coarse cells of the index are this many fine cells wide along each axis.
INDEX_FANOUT = 8
# A fine cell with more candidates is split: its edge is halved STEP times for each
# further level of the index, DEEPEST times at most (61 m for 250 km).
MAX_CANDIDATES = 64
STEP, DEEPEST = 3, 12

_CELL = ["cx", "cy", "cz"]


def _halved(near: DataFrame, e: float) -> DataFrame:
    """(cell, city) rows of cells of edge ``e``, taken to the cells of half that edge."""
    parts = F.array(*[F.struct(*[(F.col(c) * 2 + d).alias(c) for c, d in zip(_CELL, offset)])
                      for offset in itertools.product((0, 1), repeat=3)])
    rows = near.select("c", F.explode(parts).alias("_k")).select("c", "_k.*")
    rows = rows.select("c", *_CELL, *[(F.col(f"c{ax}") * (e / 2)).alias(f"_lo_{ax}") for ax in "xyz"],
                       *[((F.col(f"c{ax}") + 1) * (e / 2)).alias(f"_hi_{ax}") for ax in "xyz"])
    return _candidates(rows.where(_meets_sphere())).select(*_CELL, "c")


def nearest_city_index(geo: DataFrame, cell_km: float = DEFAULT_INDEX_CELL_KM) -> DataFrame:
    """``level, cx, cy, cz, cands``: a tree of cells over the sphere with their candidate cities.

    For a point p in cell K and any city c', d(p, nearest) <= d(p, c') <=
    maxdist(c', K); so the nearest city is among the cities with
    mindist(c, K) <= min over c' of maxdist(c', K). Exact (a tiny relative
    margin absorbs rounding), and usually one to three candidates per cell.

    Every city meets the coarse cells (``INDEX_FANOUT`` fine cells wide, a fixed
    number of them); a fine cell (level 0) then tests only its coarse parent's
    candidates. That is exact too: a fine cell's candidates, and the city
    minimising its maxdist, are all candidates of the enclosing coarse cell. In
    the same way a cell with more than ``MAX_CANDIDATES`` is split into cells of
    half its edge, so where cities lie dense the tree goes deeper; a split cell
    has NULL candidates and its parts stand ``STEP`` levels below. All steps are
    (cell, city) rows with a partially aggregated minimum per cell, so the
    dimension may have any size; a cell's candidates are gathered only at the
    end. Of cities at one place only that with the lowest ``zone_id`` can be
    nearest, so cells of the last level hold few, too.
    """
    spark = geo.sparkSession
    e = cell_km / EARTH_RADIUS_KM                      # cell edge on the unit sphere
    k = INDEX_FANOUT
    # only numbers go through the tree; names are joined to the candidates that are left
    points = materialized(city_points(geo), "city-points")
    city = points.groupBy("x", "y", "z").agg(F.min("zone_id").alias("zone_id")).select(F.struct("zone_id", "x", "y", "z").alias("c"))
    cells = _shell_cells(spark, e * k)                 # <= (2R / (k * edge) + 3)^3 rows: broadcast
    coarse = _candidates(city.crossJoin(F.broadcast(cells)))
    coarse = coarse.select(*[F.col(f"c{ax}").alias(f"_p{ax}") for ax in "xyz"], "c")
    fine = _shell_cells(spark, e).withColumns(
        {f"_p{ax}": F.floor(F.col(f"c{ax}") / k) for ax in "xyz"})
    near = _candidates(coarse.join(F.broadcast(fine), ["_px", "_py", "_pz"])).select(*_CELL, "c")     # as many as the grid has
    fields = F.struct("zone_id", "city", "tz", "lat", "lon", "x", "y", "z").alias("c")
    levels = []
    for level in range(0, DEEPEST + 1, STEP):
        near = materialized(near, "city-cells")
        full = near.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MAX_CANDIDATES).select(*_CELL)
        full = materialized(full, "city-cells") if level < DEEPEST else near.select(*_CELL).limit(0)
        split = not full.isEmpty()
        leaves = near.join(full, _CELL, "left_anti") if split else near
        named = leaves.select(*_CELL, F.col("c.zone_id").alias("zone_id")).join(points, "zone_id")
        cands = named.select(*_CELL, fields).groupBy(*_CELL).agg(F.array_sort(F.collect_list("c")).alias("cands"))
        levels.append(cands.unionByName(full.withColumn("cands", F.lit(None)), True).withColumn("level", F.lit(level)))
        if not split:
            break
        near = near.join(full, _CELL, "left_semi")
        for halving in range(STEP):
            near = materialized(_halved(near, e / 2 ** (level + halving)), "city-cells")
    return reduce(DataFrame.unionByName, levels).select("level", *_CELL, "cands")


# Broadcast the nearest-city index only up to this many bytes (measured); beyond it
# (e.g. a very large dimension) it is joined by a shuffle on the cell key instead.
MAX_BROADCAST_INDEX_BYTES = 64 << 20
_ENTRY_BYTES = 120   # of a candidate besides its two strings

_INDEXES: dict[str, tuple[StructType, int, int]] = {}   # schema, bytes and last level of the stored indexes by path
_DIMENSION = ("zone_id", "city", "tz", "lat", "lon")


def checked(geo: DataFrame) -> str:
    """Digest of the dimension's content, independent of its order; ``zone_id`` must be unique. One small job."""
    r = geo.select("zone_id", F.xxhash64(*_DIMENSION).alias("h")).agg(
        F.count("*").alias("n"), F.count_distinct("zone_id").alias("zones"), F.expr("bit_xor(h)").alias("x"),
        F.sum(F.col("h").cast("decimal(38,0)")).alias("s")).first()
    if r.zones != r.n:
        raise ValueError("geo_handbook: zone_id not unique")
    return f"{r.n}-{(r.x or 0) & (1 << 64) - 1:016x}-{int(r.s or 0) & (1 << 64) - 1:016x}"


def remember(geo: DataFrame, digest: str) -> DataFrame:
    """``geo`` with its digest at hand, for who has just checked it."""
    geo._dimension_digest = digest
    return geo


def fingerprint(geo: DataFrame) -> str:
    """Digest of the dimension's content; asked of the data unless ``sources.lake.read_geo_handbook`` has just done so."""
    return getattr(geo, "_dimension_digest", None) or checked(geo)


def stored_city_index(geo: DataFrame, cell_km: float = DEFAULT_INDEX_CELL_KM) -> tuple[DataFrame, int, int]:
    """(``nearest_city_index``, its bytes, its last level), kept in the shared folder per content of the dimension.

    A changed dimension has another fingerprint and so another index; jobs with
    the same one read it back, also from another session.
    """
    spark = geo.sparkSession
    path = f"{shared_dir(spark)}/citymarts/city-tree/{fingerprint(geo)}-{cell_km:g}-{MAX_CANDIDATES}"
    if path not in _INDEXES:
        if not path_exists(spark, f"{path}/_SUCCESS"):
            nearest_city_index(geo.select(*_DIMENSION), cell_km).write.mode("overwrite").parquet(path)
        idx = spark.read.parquet(path)
        size = F.aggregate("cands", F.lit(0).cast("bigint"), lambda a, c: a + _ENTRY_BYTES + F.coalesce(
            F.octet_length(c["city"]), F.lit(0)) + F.coalesce(F.octet_length(c["tz"]), F.lit(0)))
        r = idx.agg(F.coalesce(F.sum(size), F.lit(0)).alias("size"), F.coalesce(F.max("level"), F.lit(0)).alias("last")).first()
        _INDEXES[path] = idx.schema, int(r.size), r.last
    schema, size, last = _INDEXES[path]
    return spark.read.schema(schema).parquet(path), size, last


def with_nearest_city(df: DataFrame, geo: DataFrame, lat: str = "lat", lon: str = "lon",
                      out: str = "nearest", cell_km: float = DEFAULT_INDEX_CELL_KM) -> DataFrame:
    """Append ``out = struct(zone_id, city, tz, lat, lon)`` of the nearest city.

    NULL when the point is NULL/NaN or the dimension is empty. Ties go to the
    lowest ``zone_id``. Each row looks up its cell in the candidate index
    (``nearest_city_index``), level by level where the cells are split: a
    dimension without dense places has one level. The index is broadcast when
    its measured size is at most ``MAX_BROADCAST_INDEX_BYTES``, else joined by a
    shuffle on the cell, where rows without a cell on a level are spread by a
    hash of the row and adaptive skew splitting divides dense cells. Only where
    a cell holds several candidates, squared chord lengths of unit vectors are
    compared - the same order as the haversine distance.
    """
    x, y, z = unit_vector(lat, lon)
    smallest = cell_km / EARTH_RADIUS_KM / 2 ** DEEPEST
    t = df.withColumn("_nc_p", F.when(valid_coords(lat, lon), F.struct(
        x.alias("x"), y.alias("y"), z.alias("z"))))
    # cells of all levels from one rounding, so that each lies in its parent
    t = t.withColumns({f"_nc_f{ax}": F.floor(F.col(f"_nc_p.{ax}") / smallest) for ax in "xyz"})
    idx, size, last = stored_city_index(geo, cell_km)
    t = t.withColumn("_nc_c", F.lit(None).cast(idx.schema["cands"].dataType))
    for level in range(0, last + 1, STEP):
        part = idx.where(F.col("level") == level).select(*[F.col(c).alias(f"_nc_{c[1]}") for c in _CELL], F.col("cands").alias("_nc_n"))
        open_ = F.col("_nc_p").isNotNull() & F.col("_nc_c").isNull()
        keys = {f"_nc_{ax}": F.when(open_, F.shiftright(f"_nc_f{ax}", DEEPEST - level)) for ax in "xyz"}
        if size <= MAX_BROADCAST_INDEX_BYTES:
            part = F.broadcast(part)
        else:
            # no cell lies that far out, so these keys match nothing
            nowhere = F.lit(1 << 40) + F.pmod(F.xxhash64(*df.columns), F.lit(1 << 20))
            keys = {"_nc_x": F.coalesce(keys["_nc_x"], nowhere)} | {
                c: F.coalesce(keys[c], F.lit(0).cast("bigint")) for c in ("_nc_y", "_nc_z")}
        t = t.withColumns(keys).join(part, ["_nc_x", "_nc_y", "_nc_z"], "left")
        t = t.withColumn("_nc_c", F.coalesce("_nc_c", "_nc_n")).drop("_nc_x", "_nc_y", "_nc_z", "_nc_n")
    d = F.transform("_nc_c", lambda c: (
        F.pow(c["x"] - F.col("_nc_p.x"), 2) + F.pow(c["y"] - F.col("_nc_p.y"), 2)
        + F.pow(c["z"] - F.col("_nc_p.z"), 2)))
    best = F.when(F.size("_nc_c") <= 1, F.try_element_at("_nc_c", F.lit(1))).otherwise(
        F.element_at("_nc_c", F.array_position(d, F.array_min(d)).cast("int")))
    t = t.withColumn("_nc_b", F.when(F.col("_nc_p").isNotNull(), best))
    res = F.when(F.col("_nc_b").isNotNull(), F.struct(
        *[F.col("_nc_b")[f].alias(f) for f in ("zone_id", "city", "tz", "lat", "lon")]))
    return t.withColumn(out, res).drop("_nc_fx", "_nc_fy", "_nc_fz", "_nc_p", "_nc_c", "_nc_b")


# ---------------------------------------------------------------- spatial cells

NEIGHBOUR_OFFSETS = list(itertools.product((-1, 0, 1), repeat=3))


def cell_of(lat, lon, size_km: float) -> Column:
    """3-D cube of edge ``size_km`` containing the point (Earth-centred km).

    Two points whose great-circle distance is below ``size_km`` have a chord
    below it too, so their cells differ by at most one along each axis. No
    special case at the poles or the antimeridian.
    """
    x, y, z = unit_vector(lat, lon)
    k = EARTH_RADIUS_KM / size_km
    return F.struct(F.floor(x * k).alias("cx"), F.floor(y * k).alias("cy"),
                    F.floor(z * k).alias("cz"))


def neighbour_cells(cell: Column) -> Column:
    """The 27 cells around (and including) ``cell``."""
    return F.array(*[
        F.struct((cell["cx"] + dx).alias("cx"), (cell["cy"] + dy).alias("cy"),
                 (cell["cz"] + dz).alias("cz"))
        for dx, dy, dz in NEIGHBOUR_OFFSETS])
