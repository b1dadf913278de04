"""Points near points and points in regions.

Near pairs: latitude is cut into strips and each strip into longitude tiles; a row goes to its own
cell and, within the search distance of the lower or left border, to the neighbouring cell, so that
every pair meets in exactly one owner cell (lower strip, left tile).  Cells are range-partitioned and
sorted by longitude inside a partition; a sweep over Arrow batches keeps only the active rows whose
longitude is still in reach, so no cell is ever held as a whole.  Cells with very many rows are cut
into blocks that are compared block against block.

Regions: polygons (with holes and several pieces) are tested by ray casting over Arrow batches when
the polygon table is proven small, otherwise points and polygons meet in grid cells by an equi-join.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_008.8
#: Strip height and tile width, in multiples of the search distance.
STRIP, TILE = 4.0, 500.0
#: Rows of one cell beyond which the cell is cut into blocks.
HOT_CELL = 20_000
#: Hot cells up to which their list is broadcast (24 bytes each).
HOT_LIST = 20_000
#: Bytes of polygons up to which they are sent to every task.
REGION_BYTES = 32 << 20
#: Candidate pairs expanded at once.
CHUNK = 2_000_000
#: Beyond this latitude a strip has one tile and the sweep compares the whole strip.
POLAR = 85.0


def decode_point(wkb: bytes | None) -> tuple[float, float] | None:
    """(longitude, latitude) of a WKB point in either byte order, with or without an SRID; else None."""
    if wkb is None or len(wkb) < 21 or wkb[0] not in (0, 1):
        return None
    order = "<" if wkb[0] == 1 else ">"
    kind = struct.unpack_from(order + "I", wkb, 1)[0]
    at = 9 if kind & 0x20000000 else 5
    if kind & 0xFF != 1 or len(wkb) < at + 16:
        return None
    x, y = struct.unpack_from(order + "dd", wkb, at)
    return (x, y) if math.isfinite(x) and math.isfinite(y) else None


def decode_polygons(wkb: bytes | None) -> list[list[np.ndarray]]:
    """Pieces of a WKB polygon or multipolygon; a piece is a list of rings, a ring an (n, 2) array."""
    if not wkb:
        return []

    def read(at: int) -> tuple[list[list[np.ndarray]], int]:
        order = "<" if wkb[at] == 1 else ">"
        kind = struct.unpack_from(order + "I", wkb, at + 1)[0]
        at += 9 if kind & 0x20000000 else 5
        count = struct.unpack_from(order + "I", wkb, at)[0]
        at += 4
        pieces: list[list[np.ndarray]] = []
        if kind & 0xFF == 3:
            rings = []
            for _ in range(count):
                n = struct.unpack_from(order + "I", wkb, at)[0]
                rings.append(np.frombuffer(wkb, order + "f8", 2 * n, at + 4).reshape(n, 2).astype(float))
                at += 4 + 16 * n
            pieces.append(rings)
        elif kind & 0xFF == 6:
            for _ in range(count):
                piece, at = read(at)
                pieces += piece
        else:
            raise ValueError(f"WKB type {kind} is no polygon")
        return pieces, at

    return read(0)[0]


def _floats(column: pa.Array) -> np.ndarray:
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float)


def positions(df: DataFrame, key: str = "rec_id", lat: str = "latitude", lon: str = "longitude", geometry: str = "geometry", extra: list | None = None) -> DataFrame:
    """``(key, *extra, lat, lon)`` of every row that has a position.

    The position is latitude/longitude if both are finite, in range and not both zero, otherwise the
    point of the WKB geometry under the same conditions; rows without either do not appear.
    """
    extra = extra or []
    a, o = F.col(lat).cast("double"), F.col(lon).cast("double")
    good = F.coalesce((F.abs(a) <= 90) & (F.abs(o) <= 180) & ~F.isnan(a) & ~F.isnan(o) & ~((a == 0) & (o == 0)), F.lit(False))
    source = df.select(F.col(key).alias("k"), *extra, F.when(good, a).alias("lat"), F.when(good, o).alias("lon"), F.when(~good, F.col(geometry)).alias("g"))
    kept = [f for f in source.schema.fields if f.name != "g"]
    width = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, x = _floats(batch.column(width - 2)), _floats(batch.column(width - 1))
            for i in np.flatnonzero(np.isnan(y)):
                point = decode_point(batch.column(width)[int(i)].as_py())
                if point and abs(point[0]) <= 180 and abs(point[1]) <= 90 and point != (0.0, 0.0):
                    x[i], y[i] = point
            rows = pa.array(np.flatnonzero(~np.isnan(y)).astype(np.int64))
            columns = [batch.column(c).take(rows) for c in range(width - 2)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(y[rows.to_numpy()]), pa.array(x[rows.to_numpy()])], names=[f.name for f in kept])

    out = source.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept))
    return out.withColumnRenamed("k", key)


def _haversine(lon1: np.ndarray, lat1: np.ndarray, lon2: np.ndarray, lat2: np.ndarray) -> np.ndarray:
    a, b = np.radians(lat1), np.radians(lat2)
    h = np.sin((b - a) / 2) ** 2 + np.cos(a) * np.cos(b) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * np.arcsin(np.minimum(1.0, np.sqrt(h)))


def near_pairs(points: DataFrame, distance_m: float, key: str = "rec_id", group: str = "grp", hot_cell: int = HOT_CELL) -> DataFrame:
    """All pairs of rows at most ``distance_m`` apart whose ``group`` (int64) differs.

    ``points`` has ``key`` (int64), ``group``, ``lat``, ``lon`` (finite).  Result: ``left_id < right_id``
    and ``distance_m``; each pair once.  Rows that share ``key`` are the same row and never pair up.
    Points at one spot, poles and the date line are covered.  A null group counts as one more group.
    """
    eps = math.degrees(distance_m / EARTH_RADIUS_M) * (1 + 1e-9)
    height, width = eps * STRIP, eps * TILE
    lat, lon = F.col("lat"), F.col("lon")
    polar = F.abs(lat) > POLAR
    # longitude reach of the search circle, widened by the circle's own extent in latitude
    reach = F.lit(eps) / F.cos(F.radians(F.least(F.abs(lat) + eps, F.lit(POLAR + 1)))) * 1.001
    lon = F.when(lon == -180.0, F.lit(180.0)).otherwise(lon)
    base = points.select(F.col(key).alias("k"), F.coalesce(F.col(group).cast("long"), F.lit(-(1 << 62))).alias("grp"), "lat", lon.cast("double").alias("lon"), polar.alias("polar"), reach.alias("reach"))
    # a row just east of the date line is also offered beyond +180
    wrap = F.when(~F.col("polar") & (F.col("lon") < F.lit(-180.0) + F.col("reach")), F.array(F.col("lon"), F.col("lon") + 360.0)).otherwise(F.array(F.col("lon")))
    base = base.withColumn("lon", F.explode(wrap))
    # strips next to the polar limit use one tile too, so that pairs across the limit meet
    single = F.abs(F.col("lat")) > POLAR - 2 * eps
    strip = F.floor(F.col("lat") / height).cast("long")
    tile = F.when(single, F.lit(0)).otherwise(F.floor(F.col("lon") / width)).cast("long")
    down = (F.col("lat") - strip * F.lit(height)) <= eps
    left = ~single & ((F.col("lon") - tile * F.lit(width)) <= F.col("reach"))
    # a row outside the one-tile belt may pair with a row inside it
    belt = ~single & (F.abs(F.col("lat")) > POLAR - 4 * eps)
    cells = F.array_distinct(F.filter(F.array(
        F.struct(strip.alias("s"), tile.alias("t")),
        F.when(down, F.struct((strip - 1).alias("s"), tile.alias("t"))),
        F.when(left, F.struct(strip.alias("s"), (tile - 1).alias("t"))),
        F.when(down & left, F.struct((strip - 1).alias("s"), (tile - 1).alias("t"))),
        F.when(belt, F.struct(strip.alias("s"), F.lit(0).cast("long").alias("t"))),
        F.when(belt & down, F.struct((strip - 1).alias("s"), F.lit(0).cast("long").alias("t"))),
    ), lambda c: c.isNotNull()))
    placed = base.withColumn("c", F.explode(cells)).select("k", "grp", "lat", "lon", strip.alias("hs"), tile.alias("ht"), F.col("c.s").alias("s"), F.col("c.t").alias("t"))

    hot = placed.groupBy("s", "t").count().filter(F.col("count") > hot_cell).select("s", "t", F.ceil(F.col("count") / hot_cell).cast("int").alias("blocks"))
    listed = hot.limit(HOT_LIST + 1).collect()
    if listed:
        side = placed.sparkSession.createDataFrame(listed, hot.schema)
        side = F.broadcast(side) if len(listed) <= HOT_LIST else hot
        blocked = placed.join(side, ["s", "t"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        own = F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int")
        # block b meets every block: the meeting place (i, j), i <= j, has the number i * blocks + j
        meetings = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.least(own, o) * F.col("blocks") + F.greatest(own, o))
        placed = blocked.withColumn("b", own).withColumn("p", F.explode(meetings)).withColumn("inner", F.floor(F.col("p") / F.col("blocks")) == F.pmod("p", F.col("blocks"))).drop("blocks")
    else:
        placed = placed.select("*", F.lit(0).alias("b"), F.lit(0).alias("p"), F.lit(True).alias("inner"))
    swept = placed.select("s", "t", "p", "b", "inner", "k", "grp", "lat", "lon", "hs", "ht").repartitionByRange("s", "t", "p").sortWithinPartitions("s", "t", "p", "lon")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        active: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = [batch.column(i).cast(pa.int64() if i != 4 else pa.int8()).to_numpy(zero_copy_only=False) if i not in (7, 8) else _floats(batch.column(i)) for i in range(11)]
            old = len(active[0]) if active is not None else 0
            rows = [np.concatenate((a, f)) for a, f in zip(active, fresh)] if active is not None else fresh
            s, t, p, b, inner, k, grp, y, x, hs, ht = rows
            changed = np.ones(len(s), bool)
            changed[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1]) | (p[1:] != p[:-1])
            segment = np.cumsum(changed)
            far = np.minimum(np.abs(y) + eps, 90.0)
            dx = np.where(far > POLAR, 400.0, eps / np.cos(np.radians(np.minimum(far, POLAR + 0.5))) * 1.001)
            line = segment * 2048.0 + x
            # the reach of the left row or of the right row, whichever is wider, in this stretch
            widest = float(dx.max())
            end = np.searchsorted(line, line + np.minimum(widest, 800.0), "right")
            end = np.minimum(end, np.searchsorted(segment, segment, "right"))
            start = np.maximum(np.arange(len(s)) + 1, old)
            count = np.maximum(end - start, 0)
            done, total = 0, np.cumsum(count)
            while done < len(s):
                base_total = total[done - 1] if done else 0
                stop = max(done + 1, int(np.searchsorted(total, base_total + CHUNK, "right")))
                c = count[done:stop]
                if c.sum():
                    i = np.repeat(np.arange(done, stop), c)
                    j = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c) + np.repeat(start[done:stop], c)
                    keep = (np.abs(y[i] - y[j]) <= eps) & (grp[i] != grp[j]) & (k[i] != k[j])
                    keep &= (inner[i] != 0) | (b[i] != b[j])
                    # copies from across the date line (x > 180) meet no second copy, and no row whose reach is a whole circle
                    reach_ij = np.maximum(dx[i], dx[j])
                    keep &= (x[j] - x[i] <= reach_ij) & ((x[j] <= 180) | ((x[i] <= 180) & (reach_ij < 400)))
                    keep &= np.minimum(hs[i], hs[j]) == s[i]
                    i, j = i[keep], j[keep]
                    meters = _haversine(x[i], y[i], x[j], y[j])
                    near = meters <= distance_m
                    i, j, meters = i[near], j[near], meters[near]
                    owner = np.minimum(ht[i], ht[j]) == t[i]
                    # across the border of the one-tile belt both home tiles may differ from the meeting tile
                    edge = np.maximum(np.abs(y[i]), np.abs(y[j])) > POLAR - 2 * eps
                    keep = np.where(edge, t[i] == 0, owner)
                    i, j, meters = i[keep], j[keep], meters[keep]
                    if len(i):
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(k[i], k[j])), pa.array(np.maximum(k[i], k[j])), pa.array(meters)], names=["left_id", "right_id", "distance_m"])
                done = stop
            tail = (segment == segment[-1]) & (x >= x[-1] - np.minimum(widest, 800.0))
            active = [r[tail] for r in rows]

    return swept.mapInArrow(sweep, "left_id long, right_id long, distance_m double")


def _inside(pieces: list[list[np.ndarray]], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Even-odd ray casting over all rings: holes and detached pieces come out right."""
    odd = np.zeros(len(x), bool)
    for piece in pieces:
        for ring in piece:
            x0, y0, x1, y1 = ring[:-1, 0], ring[:-1, 1], ring[1:, 0], ring[1:, 1]
            above = (y0[None, :] > y[:, None]) != (y1[None, :] > y[:, None])
            with np.errstate(divide="ignore", invalid="ignore"):
                cross = x[:, None] < (x1 - x0)[None, :] * (y[:, None] - y0[None, :]) / (y1 - y0)[None, :] + x0[None, :]
            odd ^= (np.count_nonzero(above & cross, axis=1) & 1).astype(bool)
    return odd


def _on_border(pieces: list[list[np.ndarray]], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether points lie on an edge of any ring."""
    on = np.zeros(len(x), bool)
    for piece in pieces:
        for ring in piece:
            x0, y0, x1, y1 = ring[:-1, 0], ring[:-1, 1], ring[1:, 0], ring[1:, 1]
            cross = (x1 - x0)[None, :] * (y[:, None] - y0[None, :]) - (y1 - y0)[None, :] * (x[:, None] - x0[None, :])
            span = (np.minimum(x0, x1)[None, :] <= x[:, None]) & (x[:, None] <= np.maximum(x0, x1)[None, :]) & (np.minimum(y0, y1)[None, :] <= y[:, None]) & (y[:, None] <= np.maximum(y0, y1)[None, :])
            on |= ((cross == 0) & span).any(axis=1)
    return on


def contained(regions: list[tuple[int, tuple, list]], x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, regions) of all points inside prepared regions."""
    rows, ids = [], []
    for region, (x0, y0, x1, y1), pieces in regions:
        at = np.flatnonzero((x >= x0) & (x <= x1) & (y >= y0) & (y <= y1))
        for part in range(0, len(at), 4096):
            some = at[part : part + 4096]
            hit = some[_inside(pieces, x[some], y[some])]
            rows.append(hit)
            ids.append(np.full(len(hit), region, np.int64))
    return (np.concatenate(rows), np.concatenate(ids)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def prepare_region(region: int, wkb: bytes) -> tuple[int, tuple, list] | None:
    """(region, bounding box, pieces) for ``contained``; None for an empty geometry."""
    pieces = decode_polygons(wkb)
    if not pieces:
        return None
    all_points = np.concatenate([r for p in pieces for r in p])
    (x0, y0), (x1, y1) = all_points.min(0), all_points.max(0)
    return region, (x0, y0, x1, y1), pieces


def points_in_regions(points: DataFrame, regions: DataFrame, key: str = "rec_id", region_key: str = "locality_id", geometry: str = "geometry", region_bytes: int = REGION_BYTES, grid_deg: float = 0.25) -> DataFrame:
    """``(key, region_key)`` for every point and every region that contains it.

    Regions with null or empty geometry contain nothing.  Up to ``region_bytes`` of polygons are sent
    to the tasks (the size is measured first); more are joined with the points by grid cell.
    """
    source = points.select(F.col(key).alias("k"), "lat", "lon")
    shapes = regions.select(F.col(region_key).cast("long").alias("region"), F.col(geometry).alias("wkb")).filter(F.col("wkb").isNotNull())
    schema = f"{key} long, {region_key} long"
    size = shapes.agg(F.sum(F.length("wkb") + 64)).first()[0] or 0
    if size <= region_bytes:
        known = [tuple(r) for r in shapes.collect()]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ready = [p for r, w in known if (p := prepare_region(r, bytes(w)))]
            for batch in batches:
                rows, ids = contained(ready, _floats(batch.column(2)), _floats(batch.column(1)))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(ids)], names=[key, region_key])

        return source.mapInArrow(run, schema)

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for region, wkb in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if (p := prepare_region(region, wkb)) is None:
                    continue
                x0, y0, x1, y1 = (math.floor(v / grid_deg) for v in p[1])
                cells = [(cx, cy) for cx in range(x0, x1 + 1) for cy in range(y0, y1 + 1)]
                for part in range(0, len(cells), 1000):
                    some = cells[part : part + 1000]
                    yield pa.RecordBatch.from_arrays([pa.array([region] * len(some)), pa.array([c[0] for c in some]), pa.array([c[1] for c in some])], names=["region", "cx", "cy"])

    cells = shapes.mapInArrow(cover, "region long, cx long, cy long").join(shapes, "region")
    placed = source.withColumn("cx", F.floor(F.col("lon") / grid_deg)).withColumn("cy", F.floor(F.col("lat") / grid_deg))
    joined = placed.join(cells, ["cx", "cy"]).select("k", "lat", "lon", "region", "wkb")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[int, tuple | None] = {}
        for batch in batches:
            x, y = _floats(batch.column(2)), _floats(batch.column(1))
            ids = batch.column(3).to_numpy(zero_copy_only=False)
            hit = np.zeros(len(x), bool)
            for region in np.unique(ids):
                at = np.flatnonzero(ids == region)
                if region not in memo:
                    if len(memo) > 1000:
                        memo.clear()
                    memo[region] = prepare_region(int(region), batch.column(4)[int(at[0])].as_py())
                if memo[region] is not None:
                    hit[at] = _inside(memo[region][2], x[at], y[at])
            rows = pa.array(np.flatnonzero(hit))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(3).take(rows)], names=[key, region_key])

    return joined.mapInArrow(test, schema)


def assigned_regions(points: DataFrame, regions: DataFrame, key: str = "rec_id", region_key: str = "locality_id", geometry: str = "geometry") -> DataFrame:
    """``(key, region_key, relation, regions)``: one region per point, with the number of regions that came into question.

    A region with the point inside, not on its border, is ``within``; where there is none, regions whose
    border the point touches are ``touches``.  Of several the smallest ``region_key`` is taken, and ``regions``
    above 1 marks the assignment as ambiguous.  Points that meet no region do not appear.  A point on a
    border lies in a box of a region as well, so both relations come from the points of the regions' boxes.
    """
    boxes = points.select(F.col(key).alias("k"), "lat", "lon")
    shapes = regions.select(F.col(region_key).cast("long").alias("region"), F.col(geometry).alias("wkb")).filter(F.col("wkb").isNotNull())

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for region, wkb in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if (p := prepare_region(region, wkb)) is not None:
                    x0, y0, x1, y1 = map(float, p[1])
                    ring = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
                    # a box a little larger than the region, so that its border lies inside
                    grow = 1e-9 + 1e-12 * max(abs(v) for v in p[1])
                    ring = [(a + (grow if a == x1 else -grow), b + (grow if b == y1 else -grow)) for a, b in ring]
                    frame = struct.pack("<BIII", 1, 3, 1, 5) + b"".join(struct.pack("<dd", *q) for q in ring)
                    yield pa.RecordBatch.from_arrays([pa.array([region], pa.int64()), pa.array([frame], pa.binary())], names=["region", "frame"])

    framed = shapes.mapInArrow(frames, "region long, frame binary")
    near = points_in_regions(boxes, framed, "k", "region", "frame").join(boxes, "k").join(shapes, "region")

    def relate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[int, tuple | None] = {}
        for batch in batches:
            ids, x, y = batch.column(1).to_numpy(zero_copy_only=False), _floats(batch.column(3)), _floats(batch.column(2))
            inside, border = np.zeros(len(x), bool), np.zeros(len(x), bool)
            for region in np.unique(ids):
                at = np.flatnonzero(ids == region)
                if region not in memo:
                    if len(memo) > 1000:
                        memo.clear()
                    memo[region] = prepare_region(int(region), batch.column(4)[int(at[0])].as_py())
                for part in range(0, len(at), 4096):
                    some = at[part : part + 4096]
                    border[some] = _on_border(memo[region][2], x[some], y[some])
                    inside[some] = _inside(memo[region][2], x[some], y[some])
            hit = np.flatnonzero(inside | border)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(hit)), batch.column(1).take(pa.array(hit)), pa.array(border[hit])], names=["k", "region", "border"])

    met = near.select("k", "region", "lat", "lon", "wkb").mapInArrow(relate, "k long, region long, border boolean")
    first = met.groupBy("k", "border").agg(F.min("region").alias("region"), F.count(F.lit(1)).alias("regions"))
    best = first.groupBy("k").agg(F.min(F.struct("border", "region", "regions")).alias("b"))
    return best.select(F.col("k").alias(key), F.col("b.region").alias(region_key), F.when(F.col("b.border"), "touches").otherwise("within").alias("relation"), F.col("b.regions").alias("regions"))
