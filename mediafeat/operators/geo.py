"""Radius join and place enrichment.

Radius join without a nested loop
---------------------------------
A plain ``haversine(...) <= r`` join condition plans as a broadcast nested
loop / cartesian product.  Instead both sides get grid keys and meet in an
equi-join:

* latitude bands of height >= r (so a neighbour is at most one band away);
* each band is cut into ``n(band)`` equal longitude cells, ``n`` shrinking with
  ``cos(lat)`` so cells stay >= r wide up to the poles;
* a point sits in exactly one (band, cell); a place lists the cells of bands
  b-1..b+1 that overlap ``[lng - dlon, lng + dlon]``, where
  ``dlon = asin(sin(r/R) / cos(lat))`` is the exact longitude half-width of the
  search circle (all cells when the circle holds a pole; wraps at +-180);
* the exact haversine filter then removes the corners.

Skew: points at identical coordinates are pre-aggregated into one weighted
row and places at identical coordinates are searched once, so a hot location
costs one candidate row, not a third of the table; AQE splits what remains of
hot cells in the shuffle join.  Counts are exact, places with no neighbour
keep 0 (left semantics).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediafeat.functions.geo import EARTH_RADIUS_M, haversine_m


class Grid:
    def __init__(self, radius_m: float):
        self.theta = radius_m / EARTH_RADIUS_M
        self.dlat = math.degrees(self.theta) * (1 + 1e-9)
        self.nbands = int(math.ceil(180.0 / self.dlat))

    def band(self, lat: Column) -> Column:
        b = F.floor((lat + F.lit(90.0)) / F.lit(self.dlat))
        return F.least(F.lit(self.nbands - 1).cast("long"), F.greatest(F.lit(0).cast("long"), b)).cast("long")

    def ncells(self, band: Column) -> Column:
        lo = band.cast("double") * F.lit(self.dlat) - F.lit(90.0)
        hi = lo + F.lit(self.dlat)
        maxabs = F.least(F.lit(90.0), F.greatest(F.abs(lo), F.abs(hi)))
        n = F.floor(F.lit(360.0) * F.cos(F.radians(maxabs)) / F.lit(self.dlat))
        return F.greatest(F.lit(1).cast("long"), n).cast("long")

    def cell(self, band: Column, lng: Column) -> Column:
        n = self.ncells(band)
        return F.pmod(F.floor((lng + F.lit(180.0)) / (F.lit(360.0) / n)), n).cast("long")

    def search_keys(self, lat: Column, lng: Column) -> Column:
        """array<struct<band,cell>> covering the circle of radius r around (lat, lng)."""
        b = self.band(lat)
        bands = F.filter(F.sequence(b - 1, b + 1), lambda x: (x >= 0) & (x < self.nbands))
        s = math.sin(self.theta)
        cphi = F.cos(F.radians(lat))
        dl = F.when(cphi <= F.lit(s), F.lit(180.0)).otherwise(
            F.degrees(F.asin(F.least(F.lit(1.0), F.lit(s) / cphi))))
        dl = dl * F.lit(1 + 1e-9) + F.lit(1e-9)

        def cells(bb):
            n = self.ncells(bb)
            w = F.lit(360.0) / n
            lo = F.floor((lng - dl + F.lit(180.0)) / w)
            hi = F.floor((lng + dl + F.lit(180.0)) / w)
            return F.when(hi - lo + 1 >= n, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(
                F.transform(F.sequence(lo, hi), lambda c: F.pmod(c, n)))

        return F.flatten(F.transform(
            bands, lambda bb: F.transform(cells(bb), lambda c: F.struct(bb.alias("band"), c.alias("cell")))))


def _point_keys(points: DataFrame, grid: Grid, lat: str, lng: str) -> DataFrame:
    b = grid.band(F.col(lat))
    return points.withColumn("band", b).withColumn("cell", grid.cell(F.col("band"), F.col(lng)))


def _place_keys(locs: DataFrame, grid: Grid, lat: str, lng: str) -> DataFrame:
    k = F.explode(grid.search_keys(F.col(lat), F.col(lng))).alias("_k")
    return locs.select("*", k).select("*", F.col("_k.band").alias("band"), F.col("_k.cell").alias("cell")).drop("_k")


PAIRS_PER_CORE = 50_000_000  # candidate pairs the plain grid join may evaluate, per core (counting)
PAGE_PAIRS_PER_CORE = 5_000_000  # the same for search pages: each pair also goes through a per-place sort


def grid_pairs_estimate(places: DataFrame, points: DataFrame, radius_m: float, lat: str = "lat",
                        lng: str = "lng") -> int:
    """Exactly how many candidate pairs the grid join would evaluate: distinct
    place locations x (distinct point locations in each of their cells), from
    per-cell counts (a partial aggregate) -- no pair is formed."""
    grid = Grid(radius_m)
    pts = (points.where(F.col(lat).isNotNull() & F.col(lng).isNotNull())
                 .select(F.col(lat).alias("_plat"), F.col(lng).alias("_plng")).distinct())
    cells = _point_keys(pts, grid, "_plat", "_plng").groupBy("band", "cell").agg(F.count(F.lit(1)).alias("_cnt"))
    locs = (places.where(F.col(lat).isNotNull() & F.col(lng).isNotNull())
                  .select(F.col(lat).alias("_qlat"), F.col(lng).alias("_qlng")).distinct())
    est = _place_keys(locs, grid, "_qlat", "_qlng").join(cells, ["band", "cell"]).agg(F.sum("_cnt")).first()[0]
    return int(est or 0)


def radius_count(places: DataFrame, points: DataFrame, radius_m: float, cap: int | None = None,
                 lat: str = "lat", lng: str = "lng", out_col: str = "new_businesses",
                 method: str = "auto", pair_budget: int | None = None, full_col: str | None = None) -> DataFrame:
    """Each place with the number of points within ``radius_m`` metres.

    ``method='auto'`` measures the grid join's candidate pairs first
    (:func:`grid_pairs_estimate`); within ``pair_budget`` (default
    ``PAIRS_PER_CORE`` x cluster parallelism) the grid join runs, beyond it the
    output-sensitive :func:`radius_count_adaptive` -- so a dense area never
    turns into (places x points) pairs.  Both are exact.  With ``cap`` (a page
    size), ``full_col`` keeps the whole count beside the capped one.
    """
    if method == "auto":
        budget = pair_budget or PAIRS_PER_CORE * places.sparkSession.sparkContext.defaultParallelism
        method = "grid" if grid_pairs_estimate(places, points, radius_m, lat, lng) <= budget else "adaptive"
    if method == "adaptive":
        return radius_count_adaptive(places, points, radius_m, cap, lat, lng, out_col, full_col=full_col)
    grid = Grid(radius_m)
    pts = (points.where(F.col(lat).isNotNull() & F.col(lng).isNotNull())
                 .groupBy(F.col(lat).alias("_plat"), F.col(lng).alias("_plng"))
                 .agg(F.count(F.lit(1)).alias("_w")))
    pts = _point_keys(pts, grid, "_plat", "_plng")
    locs = (places.where(F.col(lat).isNotNull() & F.col(lng).isNotNull())
                  .select(F.col(lat).alias("_qlat"), F.col(lng).alias("_qlng")).distinct())
    locs = _place_keys(locs, grid, "_qlat", "_qlng")
    pairs = locs.join(pts, ["band", "cell"]).where(
        haversine_m(F.col("_qlat"), F.col("_qlng"), F.col("_plat"), F.col("_plng")) <= F.lit(float(radius_m)))
    counts = pairs.groupBy("_qlat", "_qlng").agg(F.sum("_w").alias("_n"))
    j = places.join(counts, (places[lat] == counts["_qlat"]) & (places[lng] == counts["_qlng"]), "left")
    n = F.coalesce(F.col("_n"), F.lit(0)).cast("bigint")
    j = j.withColumn(full_col, n) if full_col else j
    if cap is not None:
        n = F.least(n, F.lit(cap).cast("bigint"))
    return j.withColumn(out_col, n).drop("_qlat", "_qlng", "_n")


def radius_pairs(places: DataFrame, points: DataFrame, radius_m: float, place_id: str, point_id: str,
                 lat: str = "lat", lng: str = "lng") -> DataFrame:
    """(place_id, point_id, distance_m) for every point within the radius."""
    grid = Grid(radius_m)
    pts = _point_keys(points.select(F.col(point_id), F.col(lat).alias("_plat"), F.col(lng).alias("_plng")),
                      grid, "_plat", "_plng")
    pl = _place_keys(places.select(F.col(place_id), F.col(lat).alias("_qlat"), F.col(lng).alias("_qlng")),
                     grid, "_qlat", "_qlng")
    d = haversine_m(F.col("_qlat"), F.col("_qlng"), F.col("_plat"), F.col("_plng"))
    return (pl.join(pts, ["band", "cell"]).withColumn("distance_m", d)
              .where(F.col("distance_m") <= F.lit(float(radius_m)))
              .select(place_id, point_id, "distance_m"))


def search(points: DataFrame, term: str | None = None, attribute: str | None = None, location: str | None = None,
           term_col: str = "term", attribute_col: str = "attribute", location_col: str = "location") -> DataFrame:
    """The search predicate on term, attribute and named location (P8; a search by
    coordinates is :func:`nearby`); pushed to the scan."""
    p = points
    if term is not None:
        p = p.where(F.col(term_col) == term)
    if attribute is not None:
        p = p.where(F.col(attribute_col) == attribute)
    if location is not None:
        p = p.where(F.col(location_col) == location)
    return p


def nearby(places: DataFrame, points: DataFrame, radius_m: float, place_id: str, point_id: str,
           limit: int | None = 50, lat: str = "lat", lng: str = "lng", method: str = "auto",
           pair_budget: int | None = None) -> DataFrame:
    """Search results per place: nearest first (ties by point id), at most
    ``limit`` (the page size) -- exact, with two bounds on the work:

    * points sharing one coordinate are equally far from every place, so only
      the first ``limit`` of them by id can appear on any page: the rest are
      dropped before the join (``WindowGroupLimit`` per coordinate);
    * each distinct place coordinate is searched once and its page joined back
      to the places there;
    * above a measured candidate-pair budget (as in :func:`radius_count`) the
      rank-pruned hierarchy :func:`nearby_adaptive` runs instead.
    """
    if limit is None:
        return radius_pairs(places, points, radius_m, place_id, point_id, lat, lng)
    if method == "auto":
        budget = pair_budget or PAGE_PAIRS_PER_CORE * places.sparkSession.sparkContext.defaultParallelism
        method = "grid" if grid_pairs_estimate(places, points, radius_m, lat, lng) <= budget else "adaptive"
    if method == "adaptive":
        return nearby_adaptive(places, points, radius_m, place_id, point_id, limit, lat, lng)
    pts = points.select(point_id, lat, lng)
    w_loc = Window.partitionBy(lat, lng).orderBy(point_id)
    pts = pts.withColumn("_r", F.row_number().over(w_loc)).where(F.col("_r") <= limit).drop("_r")
    locs = (places.where(F.col(lat).isNotNull() & F.col(lng).isNotNull())
                  .select(F.col(lat).alias("_qlat"), F.col(lng).alias("_qlng")).distinct()
                  .withColumn("_loc", F.struct("_qlat", "_qlng")))
    pairs = radius_pairs(locs.withColumnRenamed("_qlat", lat).withColumnRenamed("_qlng", lng),
                         pts, radius_m, "_loc", point_id, lat, lng)
    w = Window.partitionBy("_loc").orderBy("distance_m", point_id)
    page = pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)
    page = page.select(F.col("_loc._qlat").alias("_qlat"), F.col("_loc._qlng").alias("_qlng"),
                       point_id, "distance_m", "rank")
    j = places.select(place_id, lat, lng).join(
        page, (F.col(lat) == F.col("_qlat")) & (F.col(lng) == F.col("_qlng")))
    return j.select(place_id, point_id, "distance_m", "rank")


def keyed_lookup(left: DataFrame, right: DataFrame, key: str, aggs: list[Column]) -> DataFrame:
    """Left rows with aggregates of their matching right rows.

    The right side is aggregated per key before the join (map-side partial
    aggregation), so a hot key meets the join as a single row."""
    r = right.groupBy(key).agg(*aggs)
    return left.join(r, key, "left")


# ---------------------------------------------------------------- adaptive exact count
class Hierarchy:
    """Nested grid levels 0..m under :class:`Grid`.

    Every point gets one finest-level integer key (B_m, C_m); the level-j key
    is (B_m >> (m-j), C_m >> (m-j)), so nesting is exact by construction (no
    floating-point disagreement between levels).  A level-j band is the
    level-0 band height / 2**j; its longitude cell count is n0(level-0 band) * 2**j.
    """

    def __init__(self, radius_m: float, levels: int):
        self.g = Grid(radius_m)
        self.m = levels
        self.scale = 1 << levels
        self.hm = self.g.dlat / self.scale
        self.nbm = self.g.nbands * self.scale

    def band_m(self, lat: Column) -> Column:
        b = F.floor((lat + F.lit(90.0)) / F.lit(self.hm))
        return F.least(F.lit(self.nbm - 1).cast("long"), F.greatest(F.lit(0).cast("long"), b)).cast("long")

    def n_at(self, band_j: Column, j: int) -> Column:
        return self.g.ncells(F.shiftright(band_j, j)) * F.lit(1 << j)

    def cell_m_raw(self, band_m: Column, lng: Column) -> Column:
        """Unwrapped finest cell index of a longitude (monotone in lng)."""
        return F.floor((lng + F.lit(180.0)) / (F.lit(360.0) / self.n_at(band_m, self.m))).cast("long")

    def keys(self, lat: Column, lng: Column) -> tuple[Column, Column]:
        bm = self.band_m(lat)
        return bm, F.pmod(self.cell_m_raw(bm, lng), self.n_at(bm, self.m)).cast("long")

    def start_keys(self, lat: Column, lng: Column) -> Column:
        """array<struct<b,c>> of level-0 cells covering the search window."""
        theta = math.degrees(self.g.theta) * (1 + 1e-9) + 1e-12
        b_lo = F.shiftright(self.band_m(lat - F.lit(theta)), self.m)
        b_hi = F.shiftright(self.band_m(lat + F.lit(theta)), self.m)
        s = math.sin(self.g.theta)
        cphi = F.cos(F.radians(lat))
        dl = F.when(cphi <= F.lit(s), F.lit(180.0)).otherwise(
            F.degrees(F.asin(F.least(F.lit(1.0), F.lit(s) / cphi))))
        dl = dl * F.lit(1 + 1e-9) + F.lit(1e-9)

        def cells(b0):
            bm = F.shiftleft(b0, self.m)  # any finest band inside b0 has the same cell count
            n0 = self.g.ncells(b0)
            lo = F.shiftright(self.cell_m_raw(bm, lng - dl), self.m)
            hi = F.shiftright(self.cell_m_raw(bm, lng + dl), self.m)
            return F.when(hi - lo + 1 >= n0, F.sequence(F.lit(0).cast("long"), n0 - 1)).otherwise(
                F.transform(F.sequence(lo, hi), lambda c: F.pmod(c, n0)))

        return F.flatten(F.transform(F.sequence(b_lo, b_hi),
                                     lambda b0: F.transform(cells(b0), lambda c: F.struct(b0.alias("b"), c.alias("c")))))

    def rect(self, b: Column, c: Column, j: int):
        h = self.g.dlat / (1 << j)
        lat_lo = b.cast("double") * F.lit(h) - F.lit(90.0)
        w = F.lit(360.0) / self.n_at(b, j)
        lng_lo = c.cast("double") * w - F.lit(180.0)
        return lat_lo, lat_lo + F.lit(h), lng_lo, lng_lo + w, w


def _classify(h: Hierarchy, j: int, qlat: Column, qlng: Column, b: Column, c: Column, r: float) -> Column:
    """'in' (every point of the cell within r), 'out' (none), 'edge' (undecided)."""
    la0, la1, lo0, lo1, w = h.rect(b, c, j)
    corners = [haversine_m(qlat, qlng, la, lo) for la in (la0, la1) for lo in (lo0, lo1)]
    dmax = F.greatest(*corners)
    cla, clo = (la0 + la1) / 2, (lo0 + lo1) / 2
    circum = F.greatest(*[haversine_m(cla, clo, la, lo) for la in (la0, la1) for lo in (lo0, lo1)])
    dcen = haversine_m(qlat, qlng, cla, clo)
    # corner arguments need a narrow cell away from the poles
    small = (w <= F.lit(90.0)) & (la0 > F.lit(-89.9)) & (la1 < F.lit(89.9))
    return (F.when(small & (dmax <= F.lit(r * (1 - 1e-9))), F.lit("in"))
             .when(small & (dcen - circum > F.lit(r * (1 + 1e-9))), F.lit("out"))
             .otherwise(F.lit("edge")))


def radius_count_adaptive(places: DataFrame, points: DataFrame, radius_m: float, cap: int | None = None,
                          lat: str = "lat", lng: str = "lng", out_col: str = "new_businesses",
                          levels: int = 8, pair_limit: int = 256, full_col: str | None = None) -> DataFrame:
    """Exact count of points within ``radius_m`` of each place, output-sensitive
    on dense areas (J2, P4).

    Cells of a nested grid are classified against each place: a cell whose four
    corners are all within the radius adds its pre-aggregated count (no point is
    touched); a cell whose centre is farther than radius + the cell's
    circumradius is dropped; a boundary cell holding at most ``pair_limit``
    points (or at the finest level) is resolved point by point; a denser one is
    split into its four children.  So a dense area costs cells along the
    circle's edge, not (places x points) pairs.  Each level's candidates are
    checkpointed to the shared folder (the loop reuses them three ways).
    """
    from mediafeat.session import checkpoint_root
    spark = places.sparkSession
    checkpoint_root(spark)
    h = Hierarchy(radius_m, levels)
    r = float(radius_m)
    pts = (points.where(F.col(lat).isNotNull() & F.col(lng).isNotNull())
                 .groupBy(F.col(lat).alias("_plat"), F.col(lng).alias("_plng")).agg(F.count(F.lit(1)).alias("_w")))
    bm, cm = h.keys(F.col("_plat"), F.col("_plng"))
    pts = pts.withColumn("_bm", bm).withColumn("_cm", cm)
    locs = (places.where(F.col(lat).isNotNull() & F.col(lng).isNotNull())
                  .select(F.col(lat).alias("_qlat"), F.col(lng).alias("_qlng")).distinct())
    cand = (locs.select("*", F.explode(h.start_keys(F.col("_qlat"), F.col("_qlng"))).alias("_k"))
                .select("_qlat", "_qlng", F.col("_k.b").alias("_b"), F.col("_k.c").alias("_c")))
    parts = []
    for j in range(levels + 1):
        shift = levels - j
        keyed = pts.select(F.shiftright("_bm", shift).alias("_b"), F.shiftright("_cm", shift).alias("_c"),
                           "_plat", "_plng", "_w")
        counts = keyed.groupBy("_b", "_c").agg(F.sum("_w").alias("_cnt"))
        c = cand.join(counts, ["_b", "_c"])  # empty cells drop out here
        c = c.withColumn("_state", _classify(h, j, F.col("_qlat"), F.col("_qlng"), F.col("_b"), F.col("_c"), r))
        c = c.where(F.col("_state") != "out").checkpoint(eager=True)
        parts.append(c.where(F.col("_state") == "in").select("_qlat", "_qlng", F.col("_cnt").alias("_n")))
        edge = c.where(F.col("_state") == "edge")
        resolve = edge if j == levels else edge.where(F.col("_cnt") <= pair_limit)
        exact = (resolve.select("_qlat", "_qlng", "_b", "_c").join(keyed, ["_b", "_c"])
                        .where(haversine_m(F.col("_qlat"), F.col("_qlng"), F.col("_plat"), F.col("_plng")) <= F.lit(r))
                        .select("_qlat", "_qlng", F.col("_w").alias("_n")))
        parts.append(exact)
        if j == levels:
            break
        dense = edge.where(F.col("_cnt") > pair_limit)
        if dense.isEmpty():
            break
        kids = F.array(*[F.struct((F.col("_b") * 2 + db).alias("b"), (F.col("_c") * 2 + dc).alias("c"))
                         for db in (0, 1) for dc in (0, 1)])
        cand = (dense.select("_qlat", "_qlng", F.explode(kids).alias("_k"))
                     .select("_qlat", "_qlng", F.col("_k.b").alias("_b"), F.col("_k.c").alias("_c")))
    total = parts[0]
    for p in parts[1:]:
        total = total.unionByName(p)
    counts = total.groupBy("_qlat", "_qlng").agg(F.sum("_n").alias("_n"))
    j = places.join(counts, (places[lat] == counts["_qlat"]) & (places[lng] == counts["_qlng"]), "left")
    n = F.coalesce(F.col("_n"), F.lit(0)).cast("bigint")
    j = j.withColumn(full_col, n) if full_col else j
    if cap is not None:
        n = F.least(n, F.lit(cap).cast("bigint"))
    return j.withColumn(out_col, n).drop("_qlat", "_qlng", "_n")


def _bounds(h: Hierarchy, j: int, qlat: Column, qlng: Column, b: Column, c: Column):
    """(lower bound, upper bound) of the distance from a place to any point of a
    cell; (0, +inf) where the corner arguments do not hold (wide or polar cells)."""
    la0, la1, lo0, lo1, w = h.rect(b, c, j)
    corners = [haversine_m(qlat, qlng, la, lo) for la in (la0, la1) for lo in (lo0, lo1)]
    cla, clo = (la0 + la1) / 2, (lo0 + lo1) / 2
    circum = F.greatest(*[haversine_m(cla, clo, la, lo) for la in (la0, la1) for lo in (lo0, lo1)])
    small = (w <= F.lit(90.0)) & (la0 > F.lit(-89.9)) & (la1 < F.lit(89.9))
    lower = F.when(small, F.greatest(F.lit(0.0), (haversine_m(qlat, qlng, cla, clo) - circum) * F.lit(1 - 1e-9)))
    upper = F.when(small, F.greatest(*corners) * F.lit(1 + 1e-9))
    return F.coalesce(lower, F.lit(0.0)), F.coalesce(upper, F.lit(float("inf")))


def nearby_adaptive(places: DataFrame, points: DataFrame, radius_m: float, place_id: str, point_id: str,
                    limit: int = 50, lat: str = "lat", lng: str = "lng", levels: int = 8,
                    pair_limit: int = 256) -> DataFrame:
    """Exact search pages (nearest ``limit`` points within the radius, ties by
    point id) that stay output-sensitive in dense areas.

    Per place and grid level, every candidate cell gets distance bounds.  Cells
    beyond the radius are dropped; sorting the place's cells by their upper
    bound, the running point count gives a distance D that already holds
    ``limit`` points, so cells whose lower bound exceeds D cannot reach the page
    and are dropped too.  Sparse survivors are resolved point by point, dense
    ones split into their four children.  A place in the middle of ten
    thousand points looks at the cells around its nearest few dozen, not at the
    ten thousand.
    """
    h = Hierarchy(radius_m, levels)
    r = float(radius_m)
    w_loc = Window.partitionBy(lat, lng).orderBy(point_id)
    pts = (points.where(F.col(lat).isNotNull() & F.col(lng).isNotNull())
                 .select(point_id, F.col(lat).alias("_plat"), F.col(lng).alias("_plng"))
                 .withColumn("_r", F.row_number().over(Window.partitionBy("_plat", "_plng").orderBy(point_id)))
                 .where(F.col("_r") <= limit).drop("_r"))
    bm, cm = h.keys(F.col("_plat"), F.col("_plng"))
    pts = pts.withColumn("_bm", bm).withColumn("_cm", cm)
    locs = (places.where(F.col(lat).isNotNull() & F.col(lng).isNotNull())
                  .select(F.col(lat).alias("_qlat"), F.col(lng).alias("_qlng")).distinct())
    cand = (locs.select("*", F.explode(h.start_keys(F.col("_qlat"), F.col("_qlng"))).alias("_k"))
                .select("_qlat", "_qlng", F.col("_k.b").alias("_b"), F.col("_k.c").alias("_c")))
    loc_w = Window.partitionBy("_qlat", "_qlng")
    found = []
    for j in range(levels + 1):
        shift = levels - j
        keyed = pts.select(F.shiftright("_bm", shift).alias("_b"), F.shiftright("_cm", shift).alias("_c"),
                           point_id, "_plat", "_plng")
        counts = keyed.groupBy("_b", "_c").agg(F.count(F.lit(1)).alias("_cnt"))
        lo, hi = _bounds(h, j, F.col("_qlat"), F.col("_qlng"), F.col("_b"), F.col("_c"))
        c = (cand.join(counts, ["_b", "_c"]).withColumn("_lo", lo).withColumn("_hi", hi)
                 .where(F.col("_lo") <= F.lit(r)))
        run = F.sum("_cnt").over(loc_w.orderBy("_hi", "_b", "_c").rowsBetween(Window.unboundedPreceding, 0))
        c = c.withColumn("_run", run)
        c = c.withColumn("_D", F.min(F.when(F.col("_run") >= limit, F.col("_hi"))).over(loc_w))
        c = c.where(F.col("_D").isNull() | (F.col("_lo") <= F.col("_D"))).drop("_run", "_D").checkpoint(eager=True)
        resolve = c if j == levels else c.where(F.col("_cnt") <= pair_limit)
        d = haversine_m(F.col("_qlat"), F.col("_qlng"), F.col("_plat"), F.col("_plng"))
        found.append(resolve.select("_qlat", "_qlng", "_b", "_c").join(keyed, ["_b", "_c"])
                            .withColumn("distance_m", d).where(F.col("distance_m") <= F.lit(r))
                            .select("_qlat", "_qlng", point_id, "distance_m"))
        if j == levels:
            break
        dense = c.where(F.col("_cnt") > pair_limit)
        if dense.isEmpty():
            break
        kids = F.array(*[F.struct((F.col("_b") * 2 + db).alias("b"), (F.col("_c") * 2 + dc).alias("c"))
                         for db in (0, 1) for dc in (0, 1)])
        cand = (dense.select("_qlat", "_qlng", F.explode(kids).alias("_k"))
                     .select("_qlat", "_qlng", F.col("_k.b").alias("_b"), F.col("_k.c").alias("_c")))
    pairs = found[0]
    for f in found[1:]:
        pairs = pairs.unionByName(f)
    page = (pairs.withColumn("rank", F.row_number().over(loc_w.orderBy("distance_m", point_id)))
                 .where(F.col("rank") <= limit))
    j = places.select(place_id, lat, lng).join(
        page, (F.col(lat) == F.col("_qlat")) & (F.col(lng) == F.col("_qlng")))
    return j.select(place_id, point_id, "distance_m", "rank")


def radius_join(places: DataFrame, points: DataFrame, metres: float, **kw) -> DataFrame:
    """Places with the count of points within ``metres`` (see :func:`radius_count`)."""
    return radius_count(places, points, metres, **kw)
