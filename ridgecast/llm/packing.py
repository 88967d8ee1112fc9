"""Best-fit packing into bins of several permitted lengths.

A document is cut into pieces of at most the largest permitted length; pieces are then packed by best fit,
longest first. Which piece goes where depends on lengths alone, so the plan is made from the histogram of lengths: at
most one entry per length up to the largest bin, however many documents there are. Planning is exact best fit
decreasing on counts: equal pieces go to the open bins with the least room that still takes them, each filled with as
many copies as fit. Where no open bin fits, a new one is opened in the least-cost size: for each permitted size the fill that
the remaining histogram allows is simulated, and the size with the least cost per token filled wins (smaller size on ties). In
the end each bin is downsized to the smallest permitted size that holds its contents.

Pieces find their place by rank among pieces of the same length. Ranks come from counts per (length, slice of ids), so
a length that a third of all pieces have is never ranked in one task: the window over a length's slices has a row per slice, eight for each
shuffle partition at most, not per piece. Segments of the plan (rank ranges)
are broadcast; their number is bounded by lengths and bin patterns, not by documents.

The length unit is words (runs of non-space characters), one extra token per document closing it.

Nulls and edges: a null, empty or blank text gives one row with n_tokens 0 and no bin. Repeated rows are packed each on its own.
A null doc_id is carried as null. Very long texts give many pieces. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgecast.llm.batches import chunks, words
from ridgecast.llm.store import shuffle_width

SIZES = (512, 1024, 2048, 4096, 8192)
OUT = "doc_id long, piece int, start long, n_tokens long, bin_id long, bin_size long, bin_offset long"


@dataclass
class Group:
    """``count`` bins alike: ``room`` left, ``items`` (length, copies) in order of placement."""

    count: int
    size: int
    room: int
    items: list = field(default_factory=list)


def default_cost(size: int) -> float:
    """Cost of a sequence: its length and a small quadratic part, as attention has."""
    return size * (1.0 + size / 65536.0)


def plan(histogram: dict[int, int], sizes: Sequence[int] = SIZES, cost=default_cost) -> list[Group]:
    """Best fit decreasing on counts; every group's bins hold the same lengths."""
    sizes = sorted(sizes)
    lengths = sorted((n for n, c in histogram.items() if c > 0), reverse=True)
    left = {n: histogram[n] for n in lengths}
    open_by_room: dict[int, list[Group]] = {}
    rooms: list[int] = []
    done: list[Group] = []

    import bisect

    def put(g: Group) -> None:
        if g.room not in open_by_room:
            open_by_room[g.room] = []
            bisect.insort(rooms, g.room)
        open_by_room[g.room].append(g)

    def best_size(n: int, at: int) -> int:
        best, chosen = None, None
        for s in sizes:
            if s < n:
                continue
            room, used = s, 0
            for m in lengths[at:]:
                if m <= room:
                    k = min(room // m, left[m])
                    room -= k * m
                    used += k * m
                if room < lengths[-1]:
                    break
            price = cost(s) / used
            if best is None or price < best:
                best, chosen = price, s
        return chosen

    for at, n in enumerate(lengths):
        while left[n]:
            k = bisect.bisect_left(rooms, n)
            if k == len(rooms):
                s = best_size(n, at)
                g = Group(max(1, left[n] // (s // n)), s, s)
            else:
                room = rooms[k]
                g = open_by_room[room].pop()
                if not open_by_room[room]:
                    del open_by_room[room]
                    del rooms[k]
            fit = g.room // n
            bins = min(g.count, left[n] // fit)
            if bins:
                if g.count > bins:
                    put(Group(g.count - bins, g.size, g.room, list(g.items)))
                full = Group(bins, g.size, g.room - fit * n, [*g.items, (n, fit)])
                left[n] -= bins * fit
            else:  # fewer pieces than one bin takes
                if g.count > 1:
                    put(Group(g.count - 1, g.size, g.room, list(g.items)))
                full = Group(1, g.size, g.room - left[n] * n, [*g.items, (n, left[n])])
                left[n] = 0
            if full.room >= lengths[-1]:
                put(full)
            else:
                done.append(full)
    done += [g for gs in open_by_room.values() for g in gs if g.items]
    for g in done:
        used = g.size - g.room
        g.size = next(s for s in sizes if s >= used)
        g.room = g.size - used
    return done


def segments(groups: list[Group]) -> dict[str, np.ndarray]:
    """Per length, consecutive rank ranges: which bins they fill, how many copies in each, at what offset."""
    rows, base, taken = [], 0, {}
    for g in groups:
        offset = 0
        for n, copies in g.items:
            first = taken.get(n, 0)
            rows.append((n, first, base, copies, offset, g.size))
            taken[n] = first + copies * g.count
            offset += n * copies
        base += g.count
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 6).T
    return dict(zip(("length", "first", "bin", "copies", "offset", "size"), cols, strict=True))


def place(seg: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, size, offset) of pieces by length and rank."""
    lo = np.searchsorted(seg["length"], length, "left")
    hi = np.searchsorted(seg["length"], length, "right")
    while True:  # the last segment of the length that begins at or before the rank
        open_ = hi - lo > 1
        if not open_.any():
            break
        mid = (lo + hi) // 2
        right = open_ & (seg["first"][np.minimum(mid, len(seg["first"]) - 1)] <= rank)
        lo = np.where(right, mid, lo)
        hi = np.where(open_ & ~right, mid, hi)
    k = rank - seg["first"][lo]
    return seg["bin"][lo] + k // seg["copies"][lo], seg["size"][lo], seg["offset"][lo] + (k % seg["copies"][lo]) * length


def _lengths(batches):
    for batch in batches:
        ids = batch.column("doc_id")
        for c in chunks(batch.column("text")):
            n = np.bincount(words(c).doc, minlength=c.n)
            yield pa.RecordBatch.from_arrays([ids.slice(c.first, c.n), pa.array(np.where(n > 0, n + 1, 0).astype(np.int64))], names=["doc_id", "n"])


def pack(docs: DataFrame, sizes: Sequence[int] = SIZES, cost=default_cost) -> DataFrame:
    """One row per piece of each row of ``docs`` (doc_id, text): see ``OUT``; bin_offset is the piece's place in its bin."""
    spark = docs.sparkSession
    top, slices = max(sizes), 8 * shuffle_width(spark)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    measured = slim.mapInArrow(_lengths, "doc_id long, n long")
    cut = measured.select("doc_id", "n", F.explode(F.expr(f"sequence(0L, greatest(n - 1, 0L) div {top})")).alias("k"))
    cut = cut.select("doc_id", F.col("k").cast("int").alias("piece"), (F.col("k") * top).alias("start"), F.least(F.col("n") - F.col("k") * top, F.lit(top)).alias("n_tokens"))
    # The slice comes from the row alone, so that a lost task, or the second pass over the texts, gives it alike. Measuring
    # texts again is cheaper than writing and reading the pieces.
    pieces = cut.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(slices)).cast("int"))
    counts = pieces.where("n_tokens > 0").groupBy("n_tokens", "slice").agg(F.count("*").alias("c"))
    histogram = {r["n_tokens"]: r["c"] for r in counts.groupBy("n_tokens").agg(F.sum("c").alias("c")).collect()}
    seg = spark.sparkContext.broadcast(segments(plan(histogram, sizes, cost)))

    from pyspark.sql import Window

    before = F.sum("c").over(Window.partitionBy("n_tokens").orderBy("slice")) - F.col("c")
    base = counts.select("n_tokens", "slice", before.alias("before"))
    own = F.row_number().over(Window.partitionBy("n_tokens", "slice").orderBy("doc_id", "piece")) - 1
    ranked = pieces.withColumn("own", own).join(base, ["n_tokens", "slice"], "left")

    def placed(batches):
        s = seg.value
        for b in batches:
            n = b.column("n_tokens").to_numpy()
            live = n > 0
            out = [np.zeros(len(n), np.int64) for _ in range(3)]
            if live.any():
                for o, v in zip(out, place(s, n[live], b.column("rank").to_numpy()[live]), strict=True):
                    o[live] = v
            cols = [pa.array(o, mask=~live) for o in out]
            yield pa.RecordBatch.from_arrays([*(b.column(x) for x in ("doc_id", "piece", "start", "n_tokens")), *cols], names=[x.split()[0] for x in OUT.split(", ")])

    rank = F.coalesce(F.col("before") + F.col("own"), F.lit(0)).cast("long").alias("rank")
    return ranked.select("doc_id", "piece", "start", "n_tokens", rank).mapInArrow(placed, OUT)
