"""Links of all transmitters and receivers within range, without a row per pair before the kernel.

Both sides are packed into rows of up to a few hundred points of one grid cell as wide as the range. Packed rows of neighbouring cells meet by an equi-join, unless
their boxes lie too far apart; pairs exist only inside a task, as numpy arrays. What is wanted per receiver or per transmitter is added up there, so no more
than a row per receiver, or per transmitter and packed row of receivers, leaves it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgecast.config import Radio
from ridgecast.operators import kernel, native, publish

RECEIVERS, TRANSMITTERS = 512, 256
#: For ``most`` of ``per_receiver``: every server is counted.
ALL = (1 << 31) - 1


def packed(points: DataFrame, key: str, radius: float, size: int, prefix: str) -> DataFrame:
    """Rows of up to ``size`` points of one cell: gx, gy, no (of the row in its cell), the box of the points and an array per column of ``points`` (key, x, y, ...)."""
    cell = lambda c, w: F.floor(F.col(c) / w).cast("long")
    # Strips of a quarter of the cell, each in the order of y: rows hold points that lie together.
    p = points.where("x is not null and y is not null").withColumns({"__gx": cell("x", radius), "__gy": cell("y", radius), "__s": cell("x", radius / 4)})
    p = p.repartition("__gx", "__gy").sortWithinPartitions("__gx", "__gy", "__s", "y", "x", key)
    kinds, columns = dict(points.dtypes), points.columns
    box = [prefix + c for c in ("x0", "x1", "y0", "y1")]
    names = ["gx", "gy", prefix + "no", *box, *(prefix + c for c in columns)]

    def run(batches):
        last, no = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            gx, gy = batch.column("__gx").to_numpy(), batch.column("__gy").to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], (gx[1:] != gx[:-1]) | (gy[1:] != gy[:-1])]))
            rows = []
            for a, b in zip(starts, np.append(starts[1:], len(gx)), strict=True):
                here = int(gx[a]), int(gy[a])
                no = no if here == last else 0
                last = here
                for at in range(a, b, size):
                    rows.append((*here, no, at, min(at + size, b)))
                    no += 1
            x, y = batch.column("x").to_numpy(), batch.column("y").to_numpy()
            first = np.array([r[3] for r in rows])
            ends = pa.array(np.append(first, rows[-1][4]).astype(np.int32))
            cut = [f.reduceat(v, first) for v in (x, y) for f in (np.minimum, np.maximum)]
            head = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*head, *map(pa.array, cut), *(pa.ListArray.from_arrays(ends, batch.column(c)) for c in columns)], names=names)

    schema = f"gx long, gy long, {prefix}no long, " + ", ".join(f"{b} double" for b in box) + "".join(f", {prefix}{c} array<{kinds[c]}>" for c in columns)
    return p.mapInArrow(run, schema)


def meeting(towers: DataFrame, receivers: DataFrame, tx: str, rx: str, radius: float, by_transmitters: bool = False) -> DataFrame:
    """Packed transmitters (t_...) and receivers (r_...) that may have pairs within ``radius``; rows of the same receivers follow each other in one partition, or those of the same transmitters."""
    near = F.array(*[F.lit(k).cast("long") for k in (-1, 0, 1)])
    t = packed(towers, tx, radius, TRANSMITTERS, "t_").withColumns({"t_gx": F.col("gx"), "t_gy": F.col("gy")}).withColumn("__dx", F.explode(near)).withColumn("__dy", F.explode(near))
    t = t.withColumns({"gx": F.col("gx") + F.col("__dx"), "gy": F.col("gy") + F.col("__dy")}).drop("__dx", "__dy")
    r = packed(receivers, rx, radius, RECEIVERS, "r_")
    gap = lambda a: F.greatest(F.col(f"t_{a}0") - F.col(f"r_{a}1"), F.col(f"r_{a}0") - F.col(f"t_{a}1"), F.lit(0.0))
    met = t.join(r, ["gx", "gy"]).where(gap("x") * gap("x") + gap("y") * gap("y") <= radius * radius * (1 + 1e-9))
    spark = towers.sparkSession
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    drop = [c for c in met.columns if c[2:] in ("x0", "x1", "y0", "y1")]
    if by_transmitters:
        return met.drop(*drop).repartition(width, "t_gx", "t_gy", "t_no").sortWithinPartitions("t_gx", "t_gy", "t_no", "gx", "gy", "r_no")
    # Those that lie nearest first: they tell soonest how strong a link must be to matter.
    met = met.withColumn("__apart", gap("x") * gap("x") + gap("y") * gap("y"))
    drop += ["t_gx", "t_gy", "t_no"]
    return met.drop(*drop).repartition(width, "gx", "gy", "r_no").sortWithinPartitions("gx", "gy", "r_no", "__apart", F.col("t_" + tx)[0]).drop("__apart")


class Unit:
    """The points of a row of ``meeting`` as arrays, and the pairs within range."""

    def __init__(self, batch, i: int, tx: str, rx: str, radius: float):
        self.key = tuple(batch.column(c)[i].as_py() for c in ("gx", "gy", "r_no"))
        self.batch, self.i = batch, i
        self.t_id, self.r_id = self._values("t_" + tx), self._values("r_" + rx)
        self.tx, self.ty, self.rx, self.ry = (self._values(c).to_numpy(zero_copy_only=False) for c in ("t_x", "t_y", "r_x", "r_y"))
        dx, dy = self.rx[:, None] - self.tx, self.ry[:, None] - self.ty
        self.r, self.t = np.nonzero(dx * dx + dy * dy <= radius * radius)

    def _values(self, name: str):
        return self.batch.column(name)[self.i].values

    def number(self, name: str) -> np.ndarray:
        return self._values(name).to_numpy(zero_copy_only=False)

    def links(self, terrain, radio: Radio, floor: float):
        """Its links of ``floor`` or more; ``r`` and ``t`` are then theirs."""
        h = self.number("t_tx_height_m")
        got = kernel.link_budget(terrain, self.tx[self.t], self.ty[self.t], h[self.t], self.rx[self.r], self.ry[self.r], radio, floor)
        keep = np.flatnonzero(got["rsrp_dbm"] >= floor)
        self.r, self.t = self.r[keep], self.t[keep]
        return {k: v[keep] for k, v in got.items()}


def _units(batches, tx, rx, radius):
    for batch in batches:
        for i in range(batch.num_rows):
            yield Unit(batch, i, tx, rx, radius)


#: Pairs of a batch that goes back to Spark.
BATCH = 1 << 16


def _batches(columns: list, names: list[str]):
    whole = pa.RecordBatch.from_arrays(columns, names=names)
    for at in range(0, whole.num_rows, BATCH):
        yield whole.slice(at, BATCH)


def pairs(towers: DataFrame, receivers: DataFrame, tx: str, rx: str, radius: float) -> DataFrame:
    """(tx, rx, distance_m) of all within ``radius`` (inclusive)."""
    met = meeting(towers.select(tx, "x", "y"), receivers.select(rx, "x", "y"), tx, rx, radius)
    # Pairs exist only between two steps of generated code.
    met = met.select("*", F.posexplode("r_x").alias("__r", "__rx")).select("*", F.posexplode("t_x").alias("__t", "__tx"))
    dx, dy = F.col("__rx") - F.col("__tx"), F.get("r_y", F.col("__r")) - F.get("t_y", F.col("__t"))
    met = met.where(dx * dx + dy * dy <= radius * radius)
    return met.select(F.get("t_" + tx, F.col("__t")).alias(tx), F.get("r_" + rx, F.col("__r")).alias(rx), F.sqrt(dx * dx + dy * dy).alias("distance_m"))


def _sides(towers, receivers, tx, rx, *more):
    return towers.select(tx, "x", "y", F.col("tx_height_m").cast("double").alias("tx_height_m")), receivers.select(rx, "x", "y", *more)


def _native(towers, receivers, terrain, tx, rx, radio, floor, schema, mode, *more, weight="", prefix="", most=-1, by_transmitters=False):
    """Links inside the JVM; what depends on the receiver alone is computed before."""
    shared = kernel.shared(towers.sparkSession, terrain)
    t, r = _sides(towers, receivers, tx, rx, *more)
    names, kinds = [*r.columns, "__clutter"], ", ".join(f"{c} {k}" for c, k in r.dtypes)

    def run(batches):
        for b in batches:
            x, y = b.column("x").to_numpy(), b.column("y").to_numpy()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(kernel.clutter(shared.value, x, y, radio))], names=names)

    r = r.where("x is not null and y is not null").mapInArrow(run, kinds + ", __clutter double")
    return native.run(meeting(t, r, tx, rx, radio.max_link_m, by_transmitters), schema, mode, terrain, tx, rx, radio, floor, weight, prefix, most)


def links(towers: DataFrame, receivers: DataFrame, terrain, tx: str, rx: str, radio: Radio = Radio(), floor_dbm: float | None = None) -> DataFrame:
    """Links of towers (tx, x, y, tx_height_m) and receivers (rx, x, y) within range: ids, signal and losses, at ``floor_dbm`` or more."""
    floor = radio.keep_floor_dbm if floor_dbm is None else floor_dbm
    kinds = dict(towers.dtypes)[tx], dict(receivers.dtypes)[rx]
    names = ["rsrp_dbm", "path_loss_db", "diffraction_db", "clutter_db", "distance_m", "is_los"]
    schema = f"{tx} {kinds[0]}, {rx} {kinds[1]}, rsrp_dbm double, path_loss_db double, diffraction_db double, clutter_db double, distance_m double, is_los boolean"
    if native.knows(terrain):
        return _native(towers, receivers, terrain, tx, rx, radio, floor, schema, native.LINKS)
    shared = kernel.shared(towers.sparkSession, terrain)

    def run(batches):
        for u in _units(batches, tx, rx, radio.max_link_m):
            got = u.links(shared.value, radio, floor)
            yield from _batches([u.t_id.take(pa.array(u.t)), u.r_id.take(pa.array(u.r)), *(pa.array(got[n]) for n in names)], [tx, rx, *names])

    return meeting(*_sides(towers, receivers, tx, rx), tx, rx, radio.max_link_m).mapInArrow(run, schema)


class _Best:
    """The strongest link of each receiver of one packed row (ties: smallest transmitter), the weakest, counts, and the strongest of older transmitters."""

    def __init__(self, unit: Unit):
        n = len(unit.r_id)
        self.key, self.ids = unit.key, unit.r_id
        self.best, self.low, self.old = np.full(n, -np.inf), np.full(n, np.inf), np.full(n, -np.inf)
        self.server, self.far, self.los = np.full(n, None, object), np.zeros(n), np.zeros(n, bool)
        self.n, self.served = np.zeros(n, np.int64), np.zeros(n, np.int64)

    def add(self, u: Unit, got: dict, threshold: float, new_prefix: str):
        rank = np.empty(len(u.t_id), np.int64)
        order = pc.sort_indices(u.t_id).to_numpy()
        rank[order] = np.arange(len(order))
        names = u.t_id.take(pa.array(order)).to_numpy(zero_copy_only=False)
        shape, at = (len(self.n), len(rank)), (u.r, rank[u.t])
        rsrp = got["rsrp_dbm"]
        table = np.full(shape, -np.inf)
        # Ids that repeat share no column, so no link is lost.
        table[at] = rsrp
        where = table.argmax(axis=1)
        row = np.arange(len(where))
        top = table[row, where]
        better = top > self.best
        for i in np.flatnonzero((top == self.best) & (top > -np.inf)):
            better[i] = names[where[i]] < self.server[i]
        far, los = np.zeros(shape), np.zeros(shape, bool)
        far[at], los[at] = got["distance_m"], got["is_los"]
        for mine, new in ((self.best, top), (self.server, names[where]), (self.far, far[row, where]), (self.los, los[row, where])):
            mine[better] = new[better]
        np.minimum(self.low, np.where(table > -np.inf, table, np.inf).min(axis=1), out=self.low)
        self.n += np.bincount(u.r, minlength=len(self.n))
        self.served += np.bincount(u.r[rsrp >= threshold], minlength=len(self.n))
        if names.dtype == object:
            old = np.array([not str(x).startswith(new_prefix) for x in names])
            np.maximum(self.old, np.where(old, table, -np.inf).max(axis=1), out=self.old)
        else:
            np.maximum(self.old, top, out=self.old)

    def batch(self, names, tx_type):
        on = np.flatnonzero(self.n)
        old = pa.array(self.old[on], mask=np.isinf(self.old[on]))
        columns = [self.ids.take(pa.array(on)), pa.array(self.best[on]), pa.array(self.server[on].tolist(), tx_type), pa.array(self.los[on]), pa.array(self.far[on]), pa.array(self.n[on]), pa.array(self.served[on]), pa.array(self.low[on]), old]
        return pa.RecordBatch.from_arrays(columns, names=names)


def per_receiver(towers: DataFrame, receivers: DataFrame, terrain, tx: str, rx: str, radio: Radio = Radio(), new_prefix: str = "NEW:", most: int | None = None) -> DataFrame:
    """Every receiver with a link: its strongest one (ties: smallest transmitter) and its counts, its weakest signal, the strongest of transmitters without ``new_prefix``.

    With ``most`` there is no n_links and no low_rsrp_dbm, and n_servers is counted up to ``most`` (left out at 0): links that are sure to change none of the rest, by an upper bound on
    their signal, are then not computed. An empty ``new_prefix`` asks for no old_rsrp_dbm.
    """
    kinds = dict(towers.dtypes)[tx], dict(receivers.dtypes)[rx]
    names = [rx, "best_rsrp_dbm", f"best_{tx}", "best_is_los", "best_distance_m", "n_links", "n_servers", "low_rsrp_dbm", "old_rsrp_dbm"]
    schema = f"{rx} {kinds[1]}, best_rsrp_dbm double, best_{tx} {kinds[0]}, best_is_los boolean, best_distance_m double, n_links long, n_servers long, low_rsrp_dbm double, old_rsrp_dbm double"

    def run(batches):
        best = None
        for u in _units(batches, tx, rx, radio.max_link_m):
            if best is None or best.key != u.key:
                if best is not None:
                    yield best.batch(names, kind)
                best, kind = _Best(u), u.t_id.type
            best.add(u, u.links(shared.value, radio, radio.keep_floor_dbm), radio.threshold_dbm, new_prefix)
        if best is not None:
            yield best.batch(names, kind)

    if native.knows(terrain):
        got = _native(towers, receivers, terrain, tx, rx, radio, radio.keep_floor_dbm, schema, native.RECEIVERS, prefix=new_prefix, most=-1 if most is None else min(most, ALL))
    else:
        shared = kernel.shared(towers.sparkSession, terrain)
        got = meeting(*_sides(towers, receivers, tx, rx), tx, rx, radio.max_link_m).mapInArrow(run, schema)
    # A receiver's id may repeat.
    order = F.struct(-F.col("best_rsrp_dbm"), F.col(f"best_{tx}"))
    strongest = {c: F.max(c).alias(c) for c in ("best_rsrp_dbm", "old_rsrp_dbm")}
    got = got.groupBy(rx).agg(strongest["best_rsrp_dbm"], *[F.min_by(c, order).alias(c) for c in (f"best_{tx}", "best_is_los", "best_distance_m")], *[F.sum(c).alias(c) for c in ("n_links", "n_servers")], F.min("low_rsrp_dbm").alias("low_rsrp_dbm"), strongest["old_rsrp_dbm"])
    if most is not None:
        got = got.withColumn("n_servers", F.least("n_servers", F.lit(most).cast("long"))).drop("n_links", "low_rsrp_dbm", *["n_servers"] * (most == 0))
    return got if new_prefix else got.drop("old_rsrp_dbm")


def per_transmitter(towers: DataFrame, receivers: DataFrame, terrain, tx: str, rx: str, radio: Radio = Radio(), floor_dbm: float | None = None, weight: str = "pop") -> DataFrame:
    """Every transmitter with a link of ``floor_dbm`` or more: n, n_served and the sum of ``weight`` over receivers that it serves."""
    floor = radio.keep_floor_dbm if floor_dbm is None else floor_dbm
    kind = dict(towers.dtypes)[tx]
    schema = f"{tx} {kind}, n long, n_served long, served double"

    def run(batches):
        for u in _units(batches, tx, rx, radio.max_link_m):
            got = u.links(shared.value, radio, floor)
            w, served, k = u.number("r_" + weight)[u.r], got["rsrp_dbm"] >= radio.threshold_dbm, len(u.t_id)
            n = np.bincount(u.t, minlength=k)
            on = np.flatnonzero(n)
            w = np.bincount(u.t[served], np.nan_to_num(w[served]), minlength=k).astype(float)  # whole numbers, if none is served
            yield pa.RecordBatch.from_arrays([u.t_id.take(pa.array(on)), pa.array(n[on]), pa.array(np.bincount(u.t[served], minlength=k)[on]), pa.array(w[on])], names=[tx, "n", "n_served", "served"])

    w = F.col(weight).cast("double").alias(weight)
    if native.knows(terrain):
        got = _native(towers, receivers, terrain, tx, rx, radio, floor, schema, native.TRANSMITTERS, w, weight=weight)
    else:
        shared = kernel.shared(towers.sparkSession, terrain)
        got = meeting(*_sides(towers, receivers, tx, rx, w), tx, rx, radio.max_link_m).mapInArrow(run, schema)
    return got.groupBy(tx).agg(*[F.sum(c).alias(c) for c in ("n", "n_served", "served")])


def footprints(towers: DataFrame, receivers: DataFrame, terrain, tx: str, rx: str, radio: Radio = Radio(), floor_dbm: float | None = None) -> DataFrame:
    """(tx, n, blob): each transmitter's records at ``floor_dbm`` or more, as ``publish.footprint_blobs`` has them; links of a transmitter meet in one task, unpacked from no exchange."""
    floor = radio.keep_floor_dbm if floor_dbm is None else floor_dbm
    kind = dict(towers.dtypes)[tx]
    # An id that repeats would be two rows of one transmitter.
    once = towers.groupBy(tx).agg(F.count("*").alias("n")).where(f"n > 1 or {tx} is null").isEmpty()
    if not native.knows(terrain) or not once or dict(receivers.dtypes)[rx] not in ("bigint", "int"):
        return publish.footprint_blobs(links(towers, receivers, terrain, tx, rx, radio, floor), tx, rx)
    whole = receivers.where(F.col(rx).isNotNull())
    return _native(towers, whole, terrain, tx, rx, radio, floor, f"{tx} {kind}, n long, blob binary", native.FOOTPRINTS, by_transmitters=True)
