"""Bridges, preference chains, interval lookups and spatial lookups as equi-joins.

No broadcast hints are given: Catalyst and AQE broadcast a side only after checking its size and
split skewed partitions otherwise. Range and spatial predicates are turned into equi-joins on
cells, so no join pairs every row with every row. Cells of polygons are joined by a merge hint, as
Catalyst takes exploded rows to be as small as the file they come from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import cell_size_nm
from .dedup import pick_row


def bridge(dim: DataFrame, key: str, members: str, member: str) -> DataFrame:
    """(key, member) pairs of an array-valued dimension column."""
    return dim.select(key, F.explode(members).alias(member)).distinct()


def overlap_bridge(left: DataFrame, left_key: str, right: DataFrame, right_key: str, member: str) -> DataFrame:
    """Keys of two bridges that share a member (species to region by common zones)."""
    return left.join(right, member).select(left_key, right_key).distinct()


def full_outer(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right, keys, "full_outer")


def fallback_chain(zones: DataFrame, climatology: DataFrame, zone: str, chain: str, station: str, doy: str,
                   fields: dict[str, list[str]], regional: dict[str, str] | None = None) -> DataFrame:
    """Per zone and field, the day-of-year norm of the first station in the zone's chain that has it.

    ``fields`` maps a test column to the columns taken with it; ``regional`` names a last-resort
    station for some fields only. Returns zone, doy, the taken columns, ``<field>_station`` and
    ``<field>_is_regional`` for every zone and day of year of the climatology.
    """
    regional = regional or {}
    days = climatology.select(doy).distinct()
    # Zones and days of year (366) are both bounded dimensions; exploding the day array pairs them.
    all_days = days.agg(F.array_sort(F.collect_set(doy)).alias("_days"))
    out = zones.select(zone).withColumn("_days", all_days.scalar()).select(zone, F.explode("_days").alias(doy))
    for field, taken in fields.items():
        links = zones.select(zone, F.posexplode(chain).alias("_prio", station))
        if field in regional:
            extra = zones.select(zone, F.lit(1_000_000).alias("_prio"), F.lit(regional[field]).alias(station))
            links = links.unionByName(extra)
        having = climatology.where(F.col(field).isNotNull()).select(station).distinct()
        chosen = pick_row(links.join(having, station, "left_semi"), [zone], ["_prio", station], keep="min")
        chosen = chosen.select(zone, F.col(station).alias(f"{field}_station"),
                               (F.col("_prio") == 1_000_000).alias(f"{field}_is_regional"))
        norms = climatology.where(F.col(field).isNotNull()).select(
            F.col(station).alias(f"{field}_station"), doy, *taken)
        out = out.join(chosen, zone, "left").join(norms, [f"{field}_station", doy], "left")
    return out


def expected_anomaly(keys: DataFrame, composite: DataFrame, slopes: DataFrame, zone: str, current: DataFrame) -> DataFrame:
    """Regime composite per zone and month, else slope times the current index, with the basis named.

    ``keys`` holds (zone, month); ``current`` one row (oni, simple_regime).
    """
    oni, regime = current.select("oni").scalar(), current.select("simple_regime").scalar()
    comp = composite.where(F.col("simple_regime") == regime).select(
        zone, "month", "mean_anom_f", "sd_anom_f", F.col("n_days").alias("_nc"))
    sens = slopes.select(zone, "month", "anom_f_per_oni", F.col("r").alias("_r"), F.col("n_days").alias("_ns"))
    j = keys.join(comp, [zone, "month"], "left").join(sens, [zone, "month"], "left").withColumns(
        {"_oni": oni, "_regime": regime})
    from_comp = F.format_string("enso_zone_composite (%s, month %d, n=%d days)", "_regime", "month", "_nc")
    from_slope = F.format_string("enso_sensitivity slope x ONI %+.2f (r=%.2f, n=%d)", "_oni", "_r", "_ns")
    has_comp, has_slope = F.col("mean_anom_f").isNotNull(), F.col("anom_f_per_oni").isNotNull()
    return j.select(*keys.columns,
                    F.coalesce("mean_anom_f", F.col("anom_f_per_oni") * F.col("_oni")).alias("anom_f"),
                    F.when(has_comp, F.col("sd_anom_f")).alias("sd_f"),
                    F.when(has_comp, from_comp).when(has_slope, from_slope).otherwise("unavailable").alias("basis"),
                    F.when(has_comp, F.col("_nc")).when(has_slope, F.col("_ns")).otherwise(0).alias("n_days"))


def product_by_lead(products: DataFrame, lead: str = "lead_days") -> DataFrame:
    """The governing product per lead day: lowest ``prio`` among those whose interval covers it.

    Intervals are expanded to their lead days (0..30), so rows then meet a plain equi-join.
    """
    spread = products.select("*", F.explode(F.sequence("lead_from", "lead_to")).alias(lead))
    return pick_row(spread, [lead], ["prio", "product"], keep="min")


def grid_cell(c: str | Column, origin: float, width: float) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.floor((c - origin) / width).cast("long")


def polygon_edges(polygons: DataFrame, rings: str = "rings") -> DataFrame:
    """One row per ring edge (closing edge included) with the polygon's other columns."""
    keep = [c for c in polygons.columns if c != rings]
    per_ring = polygons.select(*keep, F.explode(rings).alias("_ring"))
    closed = F.transform("_ring", lambda p, i: F.struct(
        p["x"].alias("x1"), p["y"].alias("y1"),
        F.get(F.col("_ring"), F.pmod(i + 1, F.size("_ring")))["x"].alias("x2"),
        F.get(F.col("_ring"), F.pmod(i + 1, F.size("_ring")))["y"].alias("y2")))
    return per_ring.select(*keep, F.inline(closed))


def polygon_cells(polygons: DataFrame, polygon_id: str, cell: float, rings: str = "rings") -> tuple[DataFrame, DataFrame]:
    """Two-dimensional cell index of polygons: cells that lie wholly inside, and the edges of the cells that the outline crosses.

    Cells that are in neither table are outside. A crossed cell carries the parity of its lower right corner (``odd``) and its number of
    edges, so a point of the cell needs those edges only (see ``points_in_polygons``). Corners are counted from the crossings of each cell row's lower border, and a
    gap between crossed cells of a row is inside if the corner on its left is; each window holds one polygon's part of one row. Edges are dealt
    to all tasks, then shuffled once, by that row; nothing is joined.
    """
    c, key, eps = F.col, [polygon_id, "_i", "_j"], cell * 1e-9
    e = polygon_edges(polygons.select(polygon_id, rings), rings).withColumns({"_lo": F.least("y1", "y2"), "_hi": F.greatest("y1", "y2")})
    n = int(polygons.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # named, or AQE would merge these few bytes into a few tasks
    dy, dx, low = F.nullif(c("y2") - c("y1"), F.lit(0.0)), c("x2") - c("x1"), c("_j") * cell
    rows = e.repartition(n).withColumn("_j", F.explode(F.sequence(grid_cell(c("_lo") - eps, 0.0, cell), grid_cell(c("_hi") + eps, 0.0, cell)))).repartition(n, polygon_id, "_j")
    # the part of the edge in this row of cells, from one height to another
    at = lambda y: F.coalesce(c("x1") + dx * (F.least(F.greatest(y, c("_lo")), c("_hi")) - c("y1")) / dy, c("x1"))
    a, b = at(low), F.when(dy.isNull(), c("x2")).otherwise(at((c("_j") + 1) * cell))
    # its cells, each at its right border, and, without a cell, where it meets the row's lower border
    places = F.concat(F.array(F.lit(None).cast("long")), F.sequence(grid_cell(F.least(a, b) - eps, 0.0, cell), grid_cell(F.greatest(a, b) + eps, 0.0, cell)))
    spread = rows.select(polygon_id, "_j", "x1", "y1", "x2", "y2", F.explode(places).alias("_i")).where(c("_i").isNotNull() | ((c("y1") > low) != (c("y2") > low)))
    spread = spread.withColumn("_x", F.when(c("_i").isNull(), c("x1") + dx * (low - c("y1")) / dy).otherwise((c("_i") + 1) * cell))

    # edges of one cell are peers
    to_the_right = Window.partitionBy(polygon_id, "_j").orderBy(F.desc("_x"), c("_i").isNull())
    counted = spread.withColumns({
        "odd": F.count_if(c("_i").isNull()).over(to_the_right.rowsBetween(Window.unboundedPreceding, 0)) % 2,
        "_n": F.count("_i").over(to_the_right.rangeBetween(Window.currentRow, Window.currentRow)),
        "_next": F.last("_i", ignorenulls=True).over(to_the_right.rowsBetween(Window.unboundedPreceding, -1))}).where(c("_i").isNotNull())
    gaps = counted.where((c("odd") == 1) & (c("_next") > c("_i") + 1))
    inside = gaps.select(polygon_id, "_j", F.explode(F.sequence(c("_i") + 1, c("_next") - 1)).alias("_i"))
    # a polygon without an id has no crossed cells, as before
    return inside, counted.where(c(polygon_id).isNotNull()).select(*key, "x1", "y1", "x2", "y2", "odd", "_n")


def points_in_polygons(points: DataFrame, polygons: DataFrame, point_id: str, polygon_id: str, cell: float,
                       rings: str = "rings") -> DataFrame:
    """(point, polygon) pairs by the even-odd rule; holes fall out of the parity.

    Points meet polygons by one equi-join on two-dimensional cells (see ``polygon_cells``). A cell of a polygon is one row that carries its
    edges, none if it lies inside, so each pair is decided in its own row: neither the candidates nor the result are shuffled. Points
    without finite coordinates are in no polygon; repeated points give one pair.
    """
    c, key = F.col, [polygon_id, "_i", "_j"]
    inside, edges = polygon_cells(polygons, polygon_id, cell, rings)
    # The parity of a point is that of its cell's corner, changed by each edge of the cell that counts for one of the two only, and by each
    # vertex right of the cell between their heights (it ends an edge that the other one goes on from). The same comparisons count the
    # corners, so an edge through a corner or along a border is counted alike on both sides, whatever is lost by rounding.
    right, low, nowhere = (c("_i") + 1) * cell, c("_j") * cell, F.lit(float("inf"))
    rise = F.coalesce(F.nullif(c("y2") - c("y1"), F.lit(0.0)), F.lit(1.0))
    at_corner = ((c("y1") > low) != (c("y2") > low)) & (c("x1") + (c("x2") - c("x1")) * (low - c("y1")) / rise > right)
    beyond = {f"v{k}": F.when((c(f"x{k}") > right) & (c(f"y{k}") > low), c(f"y{k}")).otherwise(nowhere) for k in (1, 2)}
    crossed = edges.select(*key, "odd", at_corner.alias("_c"), F.struct("x1", "y1", "x2", "y2", rise.alias("dy"), *[v.alias(n) for n, v in beyond.items()]).alias("_e")).groupBy(
        *key, "odd").agg(F.collect_list("_e").alias("_edges"), F.count_if("_c").alias("_c")).withColumn("odd", F.col("odd") + F.col("_c"))
    whole = inside.select(*key, F.lit(1).cast("long").alias("odd"), F.lit(None).cast(crossed.schema["_edges"].dataType).alias("_edges"))
    cells = crossed.select(*key, "odd", "_edges").unionByName(whole)

    finite = (F.abs("x") < 1e15 * cell) & (F.abs("y") < 1e15 * cell)
    placed = points.where(finite).groupBy(point_id).agg(F.collect_set(F.struct("x", "y")).alias("_at"))

    def in_cells(pts: DataFrame) -> DataFrame:
        # a named number of partitions, as AQE would merge these small rows into a few tasks, which then make all the pairs
        n = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return pts.withColumns({"_i": grid_cell("x", 0.0, cell), "_j": grid_cell("y", 0.0, cell)}).repartition(n, "_i", "_j")

    once = in_cells(placed.where(F.size("_at") == 1).select(point_id, F.element_at("_at", 1).alias("_p")).select(point_id, "_p.x", "_p.y"))
    often = in_cells(placed.where(F.size("_at") > 1).select(point_id, F.inline("_at")))

    def met(x1: Column, y1: Column, x2: Column, y2: Column, dy: Column, v1: Column, v2: Column) -> Column:
        on_the_right = ((y1 > c("y")) != (y2 > c("y"))) & (x1 + (x2 - x1) * (c("y") - y1) / dy > c("x"))
        return sum((F.when(t, 1).otherwise(0) for t in (v1 <= c("y"), v2 <= c("y"))), F.when(on_the_right, 1).otherwise(0))

    # up to two edges, as nearly all cells have, are plain columns of the row (an absent edge is met by nothing); a longer list is folded
    names = ("x1", "y1", "x2", "y2", "dy", "v1", "v2")
    absent = dict.fromkeys(names, F.lit(0.0)) | {"dy": F.lit(1.0), "v1": nowhere, "v2": nowhere}
    flat = [F.coalesce(F.get("_edges", F.lit(k))[n], absent[n]).alias(f"_{n}_{k}") for k in (0, 1) for n in names]
    few = cells.where(F.coalesce(F.size("_edges"), F.lit(0)) <= 2).select(*key, "odd", *flat)
    many = cells.where(F.size("_edges") > 2)

    def hits(pts: DataFrame) -> DataFrame:
        of_two = [met(*(c(f"_{n}_{k}") for n in names)) for k in (0, 1)]
        # merged in order of the cells: Catalyst takes them to be as small as the polygons' file and would broadcast them
        short = pts.join(few.hint("merge"), ["_i", "_j"]).where((c("odd") + of_two[0] + of_two[1]) % 2 == 1)
        long = pts.join(many.hint("merge"), ["_i", "_j"]).where((c("odd") + F.aggregate("_edges", F.lit(0), lambda s, e: s + met(*(e[n] for n in names)))) % 2 == 1)
        return short.select(point_id, polygon_id).unionByName(long.select(point_id, polygon_id))

    return hits(once).unionByName(hits(often).distinct())


def sample_outlook(points: DataFrame, polygons: DataFrame, point_id: str, polygon_id: str, cell: float) -> DataFrame:
    """Category and probability of the most probable polygon over each point, else equal chances."""
    inside = points_in_polygons(points, polygons, point_id, polygon_id, cell).join(
        polygons.select(polygon_id, "cat", "prob"), polygon_id)
    best = inside.groupBy(point_id).agg(F.max(F.struct("prob", "cat")).alias("_b"))
    return points.join(best, point_id, "left").withColumns({
        "cat": F.coalesce("_b.cat", F.lit("EC")), "prob": F.coalesce("_b.prob", F.lit(33.3))}).drop("_b")


def box_values(grid: DataFrame, zones: DataFrame, zone: str, half: float, lat: str = "latitude",
               lon: str = "longitude") -> DataFrame:
    """Grid rows within +/- ``half`` degrees of each zone (strict), by an equi-join on 2-D cells.

    A zone is listed in the 3 x 3 cells of width ``half`` around it; every grid row has one cell.
    """
    z = zones.select(zone, F.col("lat").alias("_zlat"), F.col("lon").alias("_zlon"))
    around = F.sequence(F.lit(-1), F.lit(1))
    z = (z.withColumn("_ci", F.explode(F.transform(around, lambda k: grid_cell("_zlat", 0.0, half) + k)))
          .withColumn("_cj", F.explode(F.transform(around, lambda k: grid_cell("_zlon", 0.0, half) + k))))
    g = grid.withColumns({"_ci": grid_cell(lat, 0.0, half), "_cj": grid_cell(lon, 0.0, half)})
    near = (F.abs(F.col(lat) - F.col("_zlat")) < half) & (F.abs(F.col(lon) - F.col("_zlon")) < half)
    return g.join(z, ["_ci", "_cj"]).where(near).drop("_ci", "_cj", "_zlat", "_zlon")


def box_median(grid: DataFrame, zones: DataFrame, zone: str, value: str, out: str, half: float = 0.12,
               date: str = "date") -> DataFrame:
    """Median of the grid values in each zone's box per day.

    Equal values are counted before the median, so what is gathered per group is its distinct values.
    """
    v = F.col(value).try_cast("double")
    inside = box_values(grid.where(v.isNotNull() & ~F.isnan(v)).withColumn("_v", v), zones, zone, half)
    counted = inside.groupBy(zone, date, "_v").agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy(zone, date).agg(F.percentile("_v", F.lit(0.5), F.col("_n")).alias(out))


def gradient(grid: DataFrame, value: str, date: str = "date", row: str = "lat_idx", col: str = "lon_idx") -> DataFrame:
    """Append d_row and d_col: central differences inside the grid, one-sided at its edges.

    Neighbours come from equi-joins on the shifted index through one window per grid row or column,
    each as long as the grid is wide.
    """
    def slope(part: list[str], order: str) -> Column:
        w = Window.partitionBy(*part).orderBy(order)
        before, after = F.lag(value).over(w), F.lead(value).over(w)
        first, last = F.row_number().over(w) == 1, F.lead(F.lit(1)).over(w).isNull()
        v = F.col(value)
        return F.when(first & last, F.lit(None).cast("double")).when(first, after - v).when(last, v - before).otherwise(
            (after - before) / 2.0)

    return grid.withColumn("d_col", slope([date, row], col)).withColumn("d_row", slope([date, col], row))


def nearest_node(grid: DataFrame, date: str, value: str, idx: str, targets: DataFrame, target_id: str, target: str, out: str) -> DataFrame:
    """Per day and target, the index of the axis node whose value is nearest; ties go to the lower index.

    The axis is cut into cells as wide as the widest gap between neighbouring nodes of any day. A node lies in one cell, a target is
    looked up in its own cell and the two beside it, which hold the nearest node of every target between a day's ends; the first and
    last node of a day are also listed in the cells beyond, where nothing else is nearer. Targets without a value have no node.
    """
    known = F.col(value).isNotNull() & ~F.isnan(value)
    nodes = grid.where(known).select(date, value, idx).distinct()
    w = Window.partitionBy(date)  # one axis of a day
    nodes = nodes.withColumns({"_gap": F.lead(value).over(w.orderBy(value, idx)) - F.col(value), "_first": F.min(value).over(w), "_last": F.max(value).over(w)})
    ends = nodes.agg(F.coalesce(F.nullif(F.max("_gap"), F.lit(0.0)), F.lit(1.0)).alias("w"), F.min(value).alias("lo"), F.max(value).alias("hi"))
    span = ends.select(F.struct("w", "lo", "hi")).scalar()
    cell = lambda x: F.floor((x - F.col("_span.lo")) / F.col("_span.w")).cast("long")
    nodes = nodes.withColumn("_span", span)
    own = cell(F.col(value))
    cells = F.sequence(F.when(F.col(value) == F.col("_first"), F.lit(-1)).otherwise(own), F.when(F.col(value) == F.col("_last"), cell(F.col("_span.hi")) + 1).otherwise(own))
    nodes = nodes.select(date, F.col(value).alias("_v"), F.col(idx).alias("_idx"), F.explode(cells).alias("_cell"))
    places = targets.where(F.col(target).isNotNull() & ~F.isnan(target)).select(target_id, F.col(target).alias("_t")).withColumn("_span", span)
    at = cell(F.greatest(F.least(F.col("_t"), F.col("_span.hi")), F.col("_span.lo")))
    places = places.select(target_id, "_t", F.explode(F.array(at - 1, at, at + 1)).alias("_cell"))
    near = nodes.join(places, "_cell").groupBy(date, target_id).agg(F.min(F.struct(F.abs(F.col("_v") - F.col("_t")).alias("d"), "_idx")).alias("_best"))
    return near.select(date, target_id, F.col("_best._idx").alias(out))


def front_strength(grid: DataFrame, zones: DataFrame, zone: str, half_cells: int = 8, date: str = "date") -> DataFrame:
    """Per zone and day: strongest and mean gradient (degF per nm) and spread in the surrounding block.

    ``grid``: date, latitude, longitude, lat_idx, lon_idx, sst_c on a regular grid per day. Zones take
    the nearest grid node; blocks meet the grid through the exploded node indexes.
    """
    axes = grid.groupBy(date).agg(
        F.min("latitude").alias("_la"), F.max("latitude").alias("_lb"), F.countDistinct("latitude").alias("_nla"),
        F.min("longitude").alias("_oa"), F.max("longitude").alias("_ob"), F.countDistinct("longitude").alias("_nlo"),
        F.avg("latitude").alias("_mean"))
    dy = F.when(F.col("_nla") > 1, (F.col("_lb") - F.col("_la")) / (F.col("_nla") - 1))
    dx = F.when(F.col("_nlo") > 1, (F.col("_ob") - F.col("_oa")) / (F.col("_nlo") - 1))
    h, w = cell_size_nm(dy, dx, "_mean")
    axes = axes.select(date, F.coalesce(h, F.lit(0.6)).alias("_h"), F.coalesce(w, F.lit(0.6)).alias("_w"))
    g = gradient(grid, "sst_c", date).join(axes, date).withColumn(
        "grad", F.hypot(F.col("d_row") / F.col("_h"), F.col("d_col") / F.col("_w")) * 9.0 / 5.0)

    centre = nearest_node(grid, date, "latitude", "lat_idx", zones, zone, "lat", "_iy").join(
        nearest_node(grid, date, "longitude", "lon_idx", zones, zone, "lon", "_ix"), [date, zone])
    block = (centre.withColumn("lat_idx", F.explode(F.sequence(F.col("_iy") - half_cells, F.col("_iy") + half_cells)))
                   .withColumn("lon_idx", F.explode(F.sequence(F.col("_ix") - half_cells, F.col("_ix") + half_cells))))
    out = block.join(g, [date, "lat_idx", "lon_idx"]).groupBy(zone, date).agg(
        F.max("grad").alias("front_f_per_nm"), F.avg("grad").alias("front_mean_f_per_nm"),
        ((F.max("sst_c") - F.min("sst_c")) * 9.0 / 5.0).alias("sst_spread_f"))
    return out.where(F.col("front_f_per_nm").isNotNull())
