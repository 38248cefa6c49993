"""Vessel pairs that were close at the same time, and each pair's closest moment."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearmiss.config import (
    BUCKET_SECONDS,
    CROWDED_CELL_PINGS,
    EARTH_RADIUS_NM,
    ENCOUNTER_NM,
    MAX_VISITS,
    MIN_PAIR_BLOCKS,
    PAIRS_PER_TASK,
    PINGS_PER_BLOCK,
)
from nearmiss.functions.geo import (
    GRID_CELL_FACTOR,
    grid_column,
    grid_columns,
    grid_reach_deg,
    grid_row,
    haversine_nm,
    lat_halfwidth_deg,
)
from nearmiss.functions.motion import epoch_seconds, time_bucket


def with_time_bucket(df: DataFrame, seconds: int = BUCKET_SECONDS, *, ts: str = "ts",
                     out: str = "bucket") -> DataFrame:
    """Add ``epoch`` (seconds) and ``bucket``: the tumbling, epoch-aligned
    ``seconds``-long slot number (a long, free of time zones)."""
    return df.withColumns({"epoch": epoch_seconds(ts), out: time_bucket(ts, seconds)})


def with_grid_cell(
    df: DataFrame,
    dmax_nm: float = ENCOUNTER_NM,
    *,
    lat: str = "lat",
    lon: str = "lon",
    neighbours: bool = False,
    cell_factor: float = GRID_CELL_FACTOR,
    earth_radius_nm: float = EARTH_RADIUS_NM,
    row_col: str = "_cy",
    col_col: str = "_cx",
) -> DataFrame:
    """Add the grid cell ``(row_col, col_col)`` of each position for a pair
    distance of ``dmax_nm`` (see ``close_pairs``).

    With ``neighbours`` each row is instead replicated into its own cell and
    every neighbouring cell it can reach within ``dmax_nm``: cells are at
    least ``cell_factor`` (≥ 2) reaches wide in both directions, so that is
    at most the nearer row and the nearer column (≤ 2×2 cells, about
    ``(1 + 2/cell_factor)²`` on average). The row's reach and column count
    are columns of their own, so each trigonometric expression runs once per
    row.
    """
    if cell_factor < 2:
        raise ValueError("cell_factor must be at least 2")
    y = grid_row(lat, dmax_nm, earth_radius_nm, cell_factor)
    cy = F.floor(y)
    if neighbours:
        # unreachable neighbours are null entries, dropped after the explode
        # (a plain filter keeps the stage in generated code)
        fy, r = y - cy, 1.0 / cell_factor
        rows = F.array(cy, F.when(fy <= r, cy - 1), F.when(fy >= 1 - r, cy + 1))
        df = df.withColumn(row_col, F.explode(rows)).filter(F.col(row_col).isNotNull())
    else:
        df = df.withColumn(row_col, cy)
    df = df.withColumn("_wr", grid_reach_deg(F.col(row_col), dmax_nm, earth_radius_nm, cell_factor))
    df = df.withColumn("_nc", grid_columns(F.col("_wr"), cell_factor))
    nc = F.col("_nc")
    fx = grid_column(lon, nc)
    cx = F.floor(fx)
    if neighbours:
        gx, rx = fx - cx, F.col("_wr") * nc / F.lit(360.0)
        cols = F.array_distinct(F.array(
            F.pmod(cx, nc),
            F.when(gx <= rx, F.pmod(cx - 1, nc)),
            F.when(gx >= 1 - rx, F.pmod(cx + 1, nc)),
        ))
        df = df.withColumn(col_col, F.explode(cols)).filter(F.col(col_col).isNotNull())
        return df.drop("_wr", "_nc")
    return df.withColumn(col_col, F.pmod(cx, nc)).drop("_wr", "_nc")


# Columns that name the place of a ping in the pair join: its cell, and the part of a crowded cell.
_CELL = ("_cy", "_cx")


def _max_level(cell_factor: float) -> int:
    """How often a cell can be halved until its side is one reach."""
    return int(math.log2(cell_factor))


def _time_cell(epoch: str, cell: int):
    return F.floor(F.col(epoch) / F.lit(cell))


def crowded_cells(
    df: DataFrame,
    dmax_nm: float = ENCOUNTER_NM,
    *,
    group_key: str = "group_key",
    bucket: str = "bucket",
    lat: str = "lat",
    lon: str = "lon",
    cell_factor: float = GRID_CELL_FACTOR,
    tolerance_s: int | None = None,
    epoch: str = "epoch",
    earth_radius_nm: float = EARTH_RADIUS_NM,
    max_pings: int = CROWDED_CELL_PINGS,
) -> DataFrame:
    """The grid cells of ``close_pairs`` (same arguments) that hold over ``max_pings`` pings in one
    group and time: their keys and ``_level``, how often each is to be halved in both directions.

    A level is added for every four times ``max_pings``, until a part's side is one reach. Counts
    are combined map-side; there is at most one row for every ``max_pings`` pings.
    """
    counts = _cell_counts(df, dmax_nm, group_key, bucket, lat, lon, cell_factor, tolerance_s, epoch, earth_radius_nm)
    times = F.ceil(F.log(4.0, F.col("_n") / F.lit(max_pings)))
    level = F.least(F.greatest(times, F.lit(1)), F.lit(_max_level(cell_factor))).cast("int")
    return counts.filter(F.col("_n") > max_pings).select(*counts.columns[:-1], level.alias("_level"))


def _cell_counts(df, dmax_nm, group_key, bucket, lat, lon, cell_factor, tolerance_s, epoch, earth_radius_nm) -> DataFrame:
    """``_n``, the pings of each group (``_g``, where it parts pairs), time ``_k`` and grid cell."""
    by = [F.col(group_key).alias("_g")]
    if tolerance_s is None:
        by.append(F.col(bucket).alias("_k"))
    else:
        if _across_groups(df, group_key, tolerance_s):
            by = []
        by.append(_time_cell(epoch, _time_cell_seconds(tolerance_s, cell_factor)).alias("_k"))
    cells = with_grid_cell(df, dmax_nm, lat=lat, lon=lon, cell_factor=cell_factor, earth_radius_nm=earth_radius_nm)
    return cells.select(*by, *_CELL).groupBy(*[c for c in ("_g",) if len(by) == 2], "_k", *_CELL).agg(
        F.count(F.lit(1)).alias("_n"))


def _across_groups(df: DataFrame, group_key: str, tolerance_s: int | None) -> bool:
    return tolerance_s is not None and isinstance(df.schema[group_key].dataType, T.DateType)


class PairBlocks(NamedTuple):
    """How ``close_pairs`` spreads vessel pairs over tasks: ``blocks`` of vessels, and the tasks.
    With ``order_by`` the pings carry their vessel's visits in that order (``closest_per_pair``)."""

    blocks: int
    partitions: int
    order_by: tuple[str, ...] = ()


def pair_blocks(
    df: DataFrame,
    dmax_nm: float = ENCOUNTER_NM,
    *,
    group_key: str = "group_key",
    bucket: str = "bucket",
    lat: str = "lat",
    lon: str = "lon",
    cell_factor: float = GRID_CELL_FACTOR,
    tolerance_s: int | None = None,
    epoch: str = "epoch",
    earth_radius_nm: float = EARTH_RADIUS_NM,
    pairs_per_task: int = PAIRS_PER_TASK,
    across_groups: bool = False,
    vessel: str = "vessel_id",
    order_by=(),
    max_visits: int = MAX_VISITS,
    pings_per_block: int = PINGS_PER_BLOCK,
) -> PairBlocks | None:
    """The ``blocks`` of ``close_pairs`` (same arguments) for a search of each pair's closest
    moment; None where shuffling the found pairs is cheaper than copying the pings.

    Counts the pings by cell (combined map-side), and from these about how many pairs to expect, as
    if pings lay evenly in their cells. The estimate only decides how the work is spread.
    ``across_groups`` is for work that is spread by block pairs alone, all groups of two vessels in
    one task (``event_track_points``): blocks are then as many as all pairs need, not those of one group.

    ``order_by`` (the pings' columns whose order, first of A, then of B, is the tie-break of
    ``closest_per_pair``) is for groups in which no vessel has over ``max_visits`` pings. The closest moment
    may then be told from the two vessels' pings (at about half as much CPU again), and no task orders its pairs.
    This is done where blocks by the pings of a group (``pings_per_block``) are fewer than those by its
    pairs, so that copies of the pings grow as the pings do; not with ``tolerance_s``, or if a vessel has
    more pings.
    """
    counts = _cell_counts(df, dmax_nm, group_key, bucket, lat, lon, cell_factor, tolerance_s, epoch, earth_radius_nm)
    share = math.pi / cell_factor**2 * (1.0 if tolerance_s is None else min(1.0, 2.0 / cell_factor))
    group = [c for c in ("_g",) if c in counts.columns]
    n = F.col("_n").cast("double")
    by_group = counts.groupBy(*group).agg(F.sum("_n").alias("_n"), F.sum(n * n / 2 * share).alias("_pairs"))
    pings, pairs, most, largest = by_group.agg(F.sum("_n"), F.sum("_pairs"), F.max("_pairs"), F.max("_n")).first()
    if not pings:
        return None
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(pairs / pairs_per_task))
    if across_groups:
        most = pairs
    blocks = max(MIN_PAIR_BLOCKS, math.ceil(math.sqrt(2 * most / pairs_per_task)))
    fewer = max(MIN_PAIR_BLOCKS, math.ceil(largest / pings_per_block))
    if order_by and tolerance_s is None and not across_groups and fewer < blocks and fewer * pings < 2 * pairs:
        visits = df.filter(F.col(vessel).isNotNull()).groupBy(group_key, vessel).agg(F.count(F.lit(1)).alias("_n"))
        if visits.agg(F.max("_n")).first()[0] <= max_visits:
            return PairBlocks(fewer, parts, tuple(order_by))
    return None if blocks * pings >= 2 * pairs else PairBlocks(blocks, parts)


# Columns that name the block pair of a vessel pair: the smaller and the larger block.
BLOCK_PAIR = ("_block_lo", "_block_hi")


def _own_block(vessel: str, blocks: PairBlocks):
    return F.pmod(F.xxhash64(vessel), F.lit(blocks.blocks)).cast("int")


def _deal(df: DataFrame, blocks: PairBlocks, one: str, other: str, group) -> DataFrame:
    """Names the block pair of the blocks ``one`` and ``other``, and puts the rows of one group and
    block pair into one partition."""
    df = df.withColumns({"_block_lo": F.least(one, other), "_block_hi": F.greatest(one, other)})
    # A join on these keys and others may use this partitioning only where Spark is told
    # not to insist on all of the join's keys.
    df.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return df.repartition(blocks.partitions, *group, *BLOCK_PAIR)


def in_block_pairs(df: DataFrame, blocks: PairBlocks, vessel: str, group=()) -> DataFrame:
    """Each ping once for every block that another vessel can be of (``_other``), all pings of one
    group and block pair in one partition."""
    others = F.explode(F.sequence(F.lit(0), F.lit(blocks.blocks - 1)))
    return _deal(df.withColumns({"_own": _own_block(vessel, blocks), "_other": others}), blocks, "_own", "_other", group)


def by_block_pair(df: DataFrame, blocks: PairBlocks, vessel_a: str, vessel_b: str) -> DataFrame:
    """Each row of two vessels in the partition of their block pair, where ``in_block_pairs`` (without
    a group) puts the pings of both."""
    df = df.withColumns({"_own": _own_block(vessel_a, blocks), "_other": _own_block(vessel_b, blocks)})
    return _deal(df, blocks, "_own", "_other", ()).drop("_own", "_other")


def _with_visits(df: DataFrame, order_by, keys, bucket: str, vessel: str, lat: str, lon: str) -> DataFrame:
    """Adds ``_visits``, the pings of the ping's vessel under ``keys``, numbered in the order
    ``order_by``; ``_visit``, the ping's own number; and ``_others``, the buckets of the other pings."""
    w = Window.partitionBy(*keys, vessel).orderBy(*order_by)
    df = df.withColumn("_visit", F.row_number().over(w))
    place = F.struct(F.col(bucket).alias("bucket"), F.col(lat).alias("lat"), F.col(lon).alias("lon"), F.col("_visit").alias("no"))
    df = df.withColumn("_visits", F.collect_list(place).over(
        w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return df.withColumn("_others", F.transform(
        F.filter("_visits", lambda v: v["no"] != F.col("_visit")), lambda v: v["bucket"]))


def _other_moment(bucket: str):
    """Whether two vessels have pings in one bucket besides the two of the pair."""
    a, b = F.col("_others_a"), F.col("_others_b")
    return (((F.size(a) > 0) & F.array_contains(a, F.col(bucket))) | ((F.size(b) > 0) & F.array_contains(b, F.col(bucket)))
            | ((F.size(a) > 0) & (F.size(b) > 0) & F.arrays_overlap(a, b)))


def _closer_moment(radius: float):
    """Whether a moment of the two vessels' visits comes before the pair's: by distance, then by
    the number of A's visit, then of B's."""
    this = F.struct("distance_nm", "_visit_a", "_visit_b")

    def before(x, y):
        return F.struct(haversine_nm(x["lat"], x["lon"], y["lat"], y["lon"], radius), x["no"], y["no"]) < this

    return F.exists("_visits_a", lambda x: F.exists(
        "_visits_b", lambda y: (x["bucket"] == y["bucket"]) & before(x, y)))


def _time_cell_seconds(tolerance_s: int, cell_factor: float) -> int:
    return int(cell_factor * max(int(tolerance_s), 1))


def _with_level(df: DataFrame, crowded: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Adds ``_level`` (0 where the cell isn't crowded); ``keys`` name the cell's keys in ``df``."""
    c = crowded.toDF(*[f"_c{name}" for name in crowded.columns])
    on = [F.col(mine) == F.col(f"_c{name}") for name, mine in keys.items() if name in crowded.columns]
    out = df.join(c, on, "left").withColumn("_level", F.coalesce("_c_level", F.lit(0)))
    return out.drop(*c.columns)


def _with_part(df: DataFrame, dmax_nm: float, lat: str, lon: str, cell_factor: float, radius: float, *,
               row_col: str, col_col: str, out: str, neighbours: bool) -> DataFrame:
    """Adds ``out``, the part of the cell ``(row_col, col_col)`` that a ping lies in; with
    ``neighbours`` a row for each part of that cell within reach of the ping.

    A cell of level 0 has one part; one of level n has 2^n rows of parts, each cut into as many
    columns. Rows of the grid with fewer than three columns (next to the poles) are cut into rows
    only, as a ping can reach a column from both sides there."""
    y = grid_row(lat, dmax_nm, radius, cell_factor) - F.col(row_col)
    reach_deg = grid_reach_deg(F.col(row_col), dmax_nm, radius, cell_factor)
    df = df.withColumn("_nc", grid_columns(reach_deg, cell_factor))
    nc = F.col("_nc")
    x = grid_column(lon, nc) - F.col(col_col)
    x = x - nc * F.round((x - 0.5) / nc)  # the nearer way round
    rows = F.expr("shiftleft(1, _level)")
    df = df.withColumns({"_py": y, "_px": x, "_rx": reach_deg * nc / F.lit(360.0), "_rows": rows,
                         "_cols": F.when(nc < 3, F.lit(1)).otherwise(rows)})
    if not neighbours:
        def index(p, n):
            return F.least(F.greatest(F.floor(F.col(p) * F.col(n)), F.lit(0)), F.col(n) - 1).cast("int")

        part = index("_py", "_rows") * F.col("_cols") + index("_px", "_cols")
        return df.withColumn(out, part).drop("_nc", "_py", "_px", "_rx", "_rows", "_cols")
    slack = 1e-9

    def within(p, n, reach):
        # first and last part, as numbers, that [p - reach, p + reach] touches
        lo = F.floor((F.col(p) - reach - slack) * F.col(n))
        hi = F.floor((F.col(p) + reach + slack) * F.col(n))
        return F.greatest(lo, F.lit(0)).cast("int"), F.least(hi, F.col(n) - 1).cast("int")

    lo_y, hi_y = within("_py", "_rows", F.lit(1.0 / cell_factor))
    lo_x, hi_x = within("_px", "_cols", F.col("_rx"))
    lo_x, hi_x = (F.when(F.col("_cols") == 1, F.lit(0)).otherwise(c) for c in (lo_x, hi_x))
    df = df.withColumns({"_ly": lo_y, "_hy": hi_y, "_lx": lo_x, "_hx": hi_x})
    df = df.filter((F.col("_ly") <= F.col("_hy")) & (F.col("_lx") <= F.col("_hx")))
    n_x = F.col("_hx") - F.col("_lx") + 1
    df = df.withColumn("_t", F.explode(F.sequence(F.lit(0), (F.col("_hy") - F.col("_ly") + 1) * n_x - 1)))
    part = (F.col("_ly") + F.floor(F.col("_t") / n_x)) * F.col("_cols") + F.col("_lx") + F.col("_t") % n_x
    return df.withColumn(out, part.cast("int")).drop(
        "_nc", "_py", "_px", "_rx", "_rows", "_cols", "_ly", "_hy", "_lx", "_hx", "_t")


def _side(df: DataFrame, suffix: str, rename: dict[str, str]) -> DataFrame:
    # one call renames every column (and gives the side fresh attribute ids)
    return df.toDF(*[rename.get(c, f"{c}{suffix}") for c in df.columns])


def close_pairs(
    df: DataFrame,
    dmax_nm: float = ENCOUNTER_NM,
    *,
    group_key: str = "group_key",
    bucket: str = "bucket",
    vessel: str = "vessel_id",
    lat: str = "lat",
    lon: str = "lon",
    cell_factor: float = GRID_CELL_FACTOR,
    tolerance_s: int | None = None,
    epoch: str = "epoch",
    earth_radius_nm: float = EARTH_RADIUS_NM,
    crowded: DataFrame | None = None,
    blocks: PairBlocks | None = None,
) -> DataFrame:
    """All ping pairs of two different vessels in the same group and time
    bucket whose great-circle distance is at most ``dmax_nm``.

    Each unordered pair appears once, as ``_a``/``_b`` columns with
    ``vessel_a < vessel_b`` compared as strings; ``distance_nm`` is added, and
    ``group_key``/``bucket`` are kept unsuffixed.

    A spatial cell is part of the equi-join keys: rows ``cell_factor`` reaches tall, each divided into as many equal
    longitude columns, each at least ``cell_factor`` reaches wide, as the row's
    latitude allows (``functions.geo``). Side A keeps its own cell, side B is
    replicated into its own cell and each neighbouring row and column it can
    reach (at most 2×2 cells), so every true pair meets in exactly one cell and
    the exact distance test stays. The result equals the brute-force result at
    any latitude, across the ±180° seam and at the poles.

    ``tolerance_s`` replaces the tumbling bucket by a time tolerance: two
    pings pair when ``|epoch_a − epoch_b| ≤ tolerance_s`` (seconds, from the
    ``epoch`` column), whatever bucket they fall in. Time is then cut into
    cells ``cell_factor·tolerance_s`` long and side B is also copied into a
    neighbouring time cell it can reach, the same trick as the spatial grid. ``bucket``
    holds A's bucket and ``bucket_b`` B's. A group that is a date does not part
    two pings then (they may lie before and after midnight): the pair's group
    is A's. Any other group, such as a file, still does.

    ``crowded`` (``crowded_cells`` of the same pings, written as a table so that its
    size is known) cuts cells that hold very many pings into parts down to one reach wide, and
    side B is copied into each part it can reach: fewer candidates a ping, and a harbour
    spread over several join keys. Any such table gives the same result.

    ``blocks`` (``pair_blocks`` of the same pings) is for many more pairs than pings that
    ``closest_per_pair`` takes next: vessels are hashed into blocks, and pings are shuffled
    (one copy for each block) so that all pairs of one group and two vessels are found in one task, and
    the pairs themselves are never shuffled. The pairs get ``_block_lo`` and ``_block_hi``,
    which ``closest_per_pair`` uses and drops; their rows are the same. Where ``blocks`` has ``order_by``,
    each side gets ``_visit``, ``_visits`` and ``_others`` too (its vessel's pings in the group), and the pair
    ``_again``, whether its vessels may have another moment, for the same use.

    Candidates are first compared by latitude and longitude differences that pairs can't
    exceed, so that the great-circle distance is computed for few of them.

    Both sides grow with the data, so the join is pinned to a shuffle
    (sort-merge) join: a size estimate that ignores the replication must not
    pick a broadcast. AQE still splits skewed partitions.
    """
    a, b, cond, la, loa, lb, lob = _join_sides(
        df, dmax_nm, group_key, bucket, vessel, lat, lon, cell_factor, tolerance_s, epoch, earth_radius_nm, crowded, blocks)
    cond.append(F.abs(F.col(la) - F.col(lb)) <= F.lit(lat_halfwidth_deg(dmax_nm, earth_radius_nm)))
    apart = F.abs(F.col(loa) - F.col(lob))
    cond.append((apart <= F.col("_reach")) | (apart >= 360.0 - F.col("_reach")))
    cond.append(F.col(f"{vessel}_a") < F.col(f"{vessel}_b"))
    dist = haversine_nm(la, loa, lb, lob, earth_radius_nm)
    cond.append(dist <= F.lit(dmax_nm))  # in the join and last: a filter would be put first
    found = a.join(b.hint("merge"), on=cond, how="inner").withColumn("distance_nm", dist)
    if "_visits_a" in found.columns:
        found = found.withColumn("_again", _other_moment(bucket)).drop("_others_a", "_others_b")
    return found.drop("_g", "_k", "_ka", "_cy", "_cx", "_cy_b", "_cx_b", "_level", "_level_b", "_part", "_part_b",
                      "_reach", "_own_a", "_other_a", "_own_b", "_other_b", "_lo_b", "_hi_b")


def _join_sides(df, dmax_nm, group_key, bucket, vessel, lat, lon, cell_factor, tolerance_s, epoch, earth_radius_nm, crowded,
                blocks=None):
    """Both sides of the pair join with their keys, and the join's condition on them."""
    tol = tolerance_s is not None
    dated = _across_groups(df, group_key, tolerance_s)
    time_key = epoch if tol else bucket
    # Rows that can never pair are dropped before the shuffle explicitly, not
    # left to inferred constraints.
    df = df.filter(F.col(vessel).isNotNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull()
                   & F.col(group_key).isNotNull() & F.col(time_key).isNotNull())
    if blocks is not None:
        df = in_block_pairs(df, blocks, vessel, () if dated else (group_key,))
        if blocks.order_by and not tol:
            df = _with_visits(df, blocks.order_by, (group_key, *BLOCK_PAIR), bucket, vessel, lat, lon)
    a = _side(df, "_a", {group_key: group_key, **({} if tol else {bucket: bucket}), **{c: c for c in BLOCK_PAIR}})
    b = _side(df, "_b", {group_key: "_g", **({} if tol else {bucket: "_k"}), **dict(zip(BLOCK_PAIR, ("_lo_b", "_hi_b")))})
    la, loa, lb, lob = f"{lat}_a", f"{lon}_a", f"{lat}_b", f"{lon}_b"
    cond = [] if dated else [F.col(group_key) == F.col("_g")]
    if blocks is not None:
        cond += [F.col("_block_lo") == F.col("_lo_b"), F.col("_block_hi") == F.col("_hi_b"),
                 F.col("_own_a") == F.col("_other_b"), F.col("_other_a") == F.col("_own_b")]
    if tol:
        tol_s = max(int(tolerance_s), 1)
        cell = _time_cell_seconds(tolerance_s, cell_factor)
        ea, eb = F.col(f"{epoch}_a"), F.col(f"{epoch}_b")
        own = F.floor(eb / F.lit(cell))
        pos = eb - own * cell
        cells = F.array(own, F.when(pos <= tol_s, own - 1), F.when(pos >= cell - tol_s, own + 1))
        a = a.withColumns({"_ka": _time_cell(f"{epoch}_a", cell), bucket: F.col(f"{bucket}_a")}).drop(
            f"{bucket}_a")
        b = b.withColumn("_k", F.explode(cells)).filter(F.col("_k").isNotNull())
        cond += [F.col("_ka") == F.col("_k"), F.abs(ea - eb) <= F.lit(tolerance_s)]
    else:
        cond.append(F.col(bucket) == F.col("_k"))
    a = with_grid_cell(a, dmax_nm, lat=la, lon=loa, cell_factor=cell_factor,
                       earth_radius_nm=earth_radius_nm)
    b = with_grid_cell(b, dmax_nm, lat=lb, lon=lob, neighbours=True, cell_factor=cell_factor,
                       earth_radius_nm=earth_radius_nm, row_col="_cy_b", col_col="_cx_b")
    a = a.withColumn("_reach", grid_reach_deg(F.col("_cy"), dmax_nm, earth_radius_nm, cell_factor))
    if blocks is None:
        cond += [F.col("_cy") == F.col("_cy_b"), F.col("_cx") == F.col("_cx_b")]
    else:
        # As a struct, which is never null: null checks of A's cell alone would go below the shuffle
        # by blocks, which then would be made twice, once for each side.
        cond.append(F.struct("_cy", "_cx") == F.struct(F.col("_cy_b").alias("_cy"), F.col("_cx_b").alias("_cx")))
    if crowded is not None:
        a = _with_level(a, crowded, {"_g": group_key, "_k": "_ka" if tol else bucket, "_cy": "_cy", "_cx": "_cx"})
        a = _with_part(a, dmax_nm, la, loa, cell_factor, earth_radius_nm, row_col="_cy", col_col="_cx",
                       out="_part", neighbours=False)
        b = _with_level(b, crowded, {"_g": "_g", "_k": "_k", "_cy": "_cy_b", "_cx": "_cx_b"})
        b = _with_part(b, dmax_nm, lb, lob, cell_factor, earth_radius_nm, row_col="_cy_b", col_col="_cx_b",
                       out="_part_b", neighbours=True).withColumnRenamed("_level", "_level_b")
        cond.append(F.col("_part") == F.col("_part_b"))
    return a, b, cond, la, loa, lb, lob


def closest_per_pair(
    pairs: DataFrame,
    *,
    group_key: str = "group_key",
    vessel: str = "vessel_id",
    tie_break=("ts_a", "ts_b"),
    earth_radius_nm: float = EARTH_RADIUS_NM,
) -> DataFrame:
    """One row per (group, vessel A, vessel B): the smallest distance, ties
    broken by ``tie_break`` (end it with unique ids for a total order).

    Of pairs that ``close_pairs`` found by blocks, all of one group and two vessels lie in one
    task already. Else ``row_number() == 1`` lets Catalyst insert a partial WindowGroupLimit
    before the shuffle, so only each map task's best row per pair moves.

    Pairs that carry their vessels' visits (``pair_blocks`` with ``order_by``, which must be the columns
    of ``tie_break``, and ``earth_radius_nm`` that of ``close_pairs``) aren't ordered at all:
    each is kept if the visits hold no closer moment.
    """
    blocks = [c for c in BLOCK_PAIR if c in pairs.columns]
    if "_visits_a" in pairs.columns:
        # A filter would be put into the join and computed there for each candidate; explode isn't.
        kept = F.explode(F.when(~F.col("_again") | ~_closer_moment(earth_radius_nm), F.array(F.lit(True))))
        return pairs.withColumn("_kept", kept).drop(
            "_kept", "_again", "_visit_a", "_visits_a", "_visit_b", "_visits_b", *blocks)
    w = Window.partitionBy(f"{vessel}_a", f"{vessel}_b", group_key, *blocks).orderBy("distance_nm", *tie_break)
    return pairs.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank", *blocks)
