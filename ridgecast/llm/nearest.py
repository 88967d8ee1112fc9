"""Approximate nearest neighbours over balanced posting lists (after SPANN, Chen et al., 2021).

Candidates: of equal vectors only the ``k + 1`` smallest ids can ever be among a query's ``k`` nearest, for ties go to the smaller id; all
others are left out before indexing, by a limit within each task and then across tasks, so a vector that a third of the table has is a few rows.

Index: centroids come from recursive balanced two-means over a sample of the candidates (those of smallest hash, ``sample`` or 8 for each list).
There is a list for every ``list_size`` candidates, up to ``max_lists``: at most 16,384 centroids and their neighbour graph are broadcast; beyond 4 million
distinct vectors lists get longer instead. Every candidate is indexed: it goes to its nearest list and to each further list whose distance is
within ``1 + boundary`` of the nearest, up to ``copies`` lists; more copies only help queries, no row is left out. A query finds its nearest
centroids by best-first search in an in-memory neighbour graph and probes all lists within a ratio of the nearest one's distance. That ratio is
set from the sample: it is what ``aim`` of the sample's true neighbours need.

Lists are dealt in blocks of about ``block`` rows, so a popular list does not meet in one task; queries stream past a block, which
answers each with its ``k`` nearest. Scores are cosines of the original vectors in double precision, computed pair by pair; vectors are
scaled by powers of two first, which is exact, so neither very large nor very small components overflow.

Nulls and edges: rows with a null id, or a vector that is null, empty, zero, of another length than most, or holding a null or
non-finite component, take no part, neither as query nor candidate. Rows that repeat an id are one candidate (its best score);
a query never finds its own id. Fewer candidates than ``k`` give fewer rows, an empty table none. Ties go to the smaller id. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgecast.llm.store import materialize, shuffle_width


def valid(vec: str = "embedding") -> Column:
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vec).isNotNull() & (F.size(vec) > 0) & fine & F.exists(vec, lambda x: x != 0), F.lit(False))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def balanced_centroids(x: np.ndarray, lists: int, share: float = 0.4) -> np.ndarray:
    """``lists`` centroids of unit vectors; each split gives either side at least ``share`` of the rows."""
    rng = np.random.default_rng(7)
    out, todo = [], [(np.arange(len(x)), lists)]
    while todo:
        rows, k = todo.pop()
        if k <= 1 or len(rows) < 2:
            c = x[rows].mean(axis=0)
            out.append(c / max(np.linalg.norm(c), 1e-12))
            continue
        y = x[rows]
        c = y[rng.choice(len(rows), 2, replace=False)]
        want = (k // 2) / k
        low, high = int(len(rows) * max(0.0, want - (0.5 - share))), int(np.ceil(len(rows) * min(1.0, want + (0.5 - share))))
        low, high = max(1, low), min(len(rows) - 1, max(high, 1))
        for _ in range(12):
            lead = y @ (c[0] - c[1])
            order = np.argsort(-lead, kind="stable")
            cut = int(np.clip((lead > 0).sum(), low, high))
            left, right = order[:cut], order[cut:]
            c = np.stack([y[left].mean(axis=0), y[right].mean(axis=0)])
        todo += [(rows[left], k // 2), (rows[right], k - k // 2)]
    return np.stack(out)


def neighbour_graph(c: np.ndarray, degree: int = 24) -> np.ndarray:
    """Each centroid's nearest ones, and a ring, so that every centroid can be reached."""
    near = np.argsort(-(c @ c.T), axis=1, kind="stable")[:, 1 : degree + 1]
    ring = (np.arange(len(c)) + 1) % len(c)
    return np.column_stack([near, ring, (np.arange(len(c)) - 1) % len(c)])


def graph_search(q: np.ndarray, c: np.ndarray, graph: np.ndarray, ratio: float, beam: int = 16) -> list[np.ndarray]:
    """Lists within ``ratio`` of the nearest centroid's distance, by best-first search from a few entries, many queries at once.

    A query stops when the nearest centroid not yet expanded lies beyond the ratio and ``beam`` have been expanded.
    """
    n, k = len(q), len(c)
    dist = np.full((n, k), np.inf)
    expanded = np.zeros((n, k), bool)
    for e in np.unique(np.linspace(0, k - 1, 8).astype(int)):
        dist[:, e] = np.sqrt(np.maximum(0, 2 - 2 * (q @ c[e])))
    live = np.arange(n)
    steps = 0
    while len(live):
        frontier = np.where(expanded[live], np.inf, dist[live])
        at = frontier.argmin(axis=1)
        d = frontier[np.arange(len(live)), at]
        on = np.isfinite(d) & ((d <= ratio * dist[live].min(axis=1)) | (steps < beam))
        live, at = live[on], at[on]
        if not len(live):
            break
        expanded[live, at] = True
        near = graph[at]
        new = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("qd,qnd->qn", q[live], c[near])))
        dist[live[:, None], near] = new
        steps += 1
    return [np.flatnonzero(row <= ratio * row.min()) for row in dist]


def lists_of(x: np.ndarray, c: np.ndarray, boundary: float, copies: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, list) of every row's lists, nearest first."""
    d = np.sqrt(np.maximum(0, 2 - 2 * (x @ c.T)))
    copies = min(copies, len(c))
    part = np.argpartition(d, copies - 1, axis=1)[:, :copies]
    dd = np.take_along_axis(d, part, 1)
    return (m := np.nonzero(dd <= (1 + boundary) * dd.min(axis=1, keepdims=True)))[0], part[m]


def fit_ratio(x: np.ndarray, c: np.ndarray, boundary: float, copies: int, k: int, aim: float, probes: int = 300) -> float:
    """The distance ratio at which a share ``aim`` of true neighbours in the sample lies in a probed list."""
    q = x[:: max(1, len(x) // probes)][:probes]
    s = q @ x.T
    s[np.arange(len(q)), np.arange(0, len(x), max(1, len(x) // probes))[: len(q)]] = -np.inf
    near = np.argpartition(-s, min(k, len(x) - 1) - 1, axis=1)[:, : min(k, len(x) - 1)]
    d = np.sqrt(np.maximum(1e-12, 2 - 2 * (q @ c.T)))
    rel = d / d.min(axis=1, keepdims=True)
    row, lst = lists_of(x, c, boundary, copies)
    of = np.split(lst, np.searchsorted(row, np.arange(1, len(x))))
    need = [rel[i, of[j]].min() for i in range(len(q)) for j in near[i]]
    return float(np.quantile(need, aim)) * (1 + 1e-9) if need else 1.0


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    return np.concatenate([np.frombuffer(b.as_buffer(), dtype) for b in column]).reshape(len(column), -1) if len(column) else np.zeros((0, 0), dtype)


def search(vectors: DataFrame, every: int = 50, k: int = 5, list_size: int = 256, max_lists: int = 16384, sample: int = 20000, boundary: float = 0.15, copies: int = 8, aim: float = 0.97, block: int = 2048) -> DataFrame:
    """Queries are the rows of ``vectors`` (vec_id, embedding) whose id is divisible by ``every``: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    sc = spark.sparkContext
    kind = dict(vectors.dtypes)["embedding"]
    dtype = np.float32 if kind == "array<float>" else np.float64
    base = vectors.where(F.col("vec_id").isNotNull() & valid()).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>" if dtype == np.float32 else "array<double>").alias("e"))
    lengths = base.groupBy(F.size("e").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    out = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], out)
    dim = lengths["n"]
    base = materialize(base.where(F.size("e") == dim).distinct(), "vectors")
    place = F.row_number().over(Window.partitionBy("e").orderBy("vec_id"))
    candidates = materialize(base.withColumn("place", place).where(F.col("place") <= k + 1).drop("place"), "candidates")
    lists = int(np.clip(candidates.count() // list_size, 1, max_lists))
    got = candidates.orderBy(F.xxhash64("vec_id"), "vec_id").limit(max(sample, 8 * lists)).select("e").toArrow()["e"].combine_chunks()
    x = _unit(got.flatten().to_numpy().reshape(-1, dim))
    lists = min(lists, max(1, len(x) // 8))
    c = balanced_centroids(x, lists)
    ratio = fit_ratio(x, c, boundary, copies, k, aim) if len(x) > 1 else 1.0
    index = sc.broadcast((c, neighbour_graph(c), ratio))

    def flat(column) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(-1, dim)

    def post(batches):
        c, _, _ = index.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                v = flat(b.column("e"))
                row, lst = lists_of(_unit(v), c, boundary, copies)
                raw = [r.tobytes() for r in v]
                yield pa.RecordBatch.from_arrays([pa.array(lst.astype(np.int32)), b.column("vec_id").take(pa.array(row)), pa.array([raw[i] for i in row], pa.binary())], names=["list", "id", "v"])

    def ask(batches):
        c, graph, ratio = index.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                v = flat(b.column("e"))
                found = graph_search(_unit(v), c, graph, ratio)
                row = np.repeat(np.arange(len(v)), [len(f) for f in found])
                raw = [r.tobytes() for r in v]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).astype(np.int32)), b.column("vec_id").take(pa.array(row)), pa.array([raw[i] for i in row], pa.binary())], names=["list", "id", "v"])

    posted = "list int, id long, v binary"
    postings = materialize(candidates.mapInArrow(post, posted), "postings")
    sizes = postings.groupBy("list").agg(F.count("*").alias("rows")).select("list", F.ceil(F.col("rows") / block).cast("int").alias("blocks"))
    sizes = F.broadcast(sizes)  # a row per list, at most max_lists
    members = postings.join(sizes, "list").select("list", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("kind"), "id", "v")
    asked = base.where(F.col("vec_id") % every == 0).mapInArrow(ask, posted)
    questions = asked.join(sizes, "list").select("list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("kind"), "id", "v")
    dealt = members.unionByName(questions).repartition(shuffle_width(spark), "list", "block").sortWithinPartitions("list", "block", "kind")

    def scan(batches):
        here, ids, vecs = None, [], []
        for batch in batches:
            lst, blk, knd = (batch.column(n).to_numpy() for n in ("list", "block", "kind"))
            edge = np.flatnonzero(np.concatenate([[True], (lst[1:] != lst[:-1]) | (blk[1:] != blk[:-1]) | (knd[1:] != knd[:-1])]))
            for a, b in zip(edge, np.append(edge[1:], len(lst)), strict=True):
                key = (lst[a], blk[a])
                i, v = batch.column("id").slice(a, b - a).to_numpy(), _matrix(batch.column("v").slice(a, b - a), dtype)
                if key != here:
                    here, ids, vecs = key, [], []
                if knd[a] == 0:
                    ids.append(i)
                    vecs.append(v)
                    continue
                if not ids:
                    continue
                if len(ids) > 1:
                    ids, vecs = [np.concatenate(ids)], [np.concatenate(vecs)]
                for at in range(0, len(i), 512):
                    yield _best(i[at : at + 512], v[at : at + 512], ids[0], vecs[0], k)

    hits = dealt.mapInArrow(scan, "query_id long, vec_id long, score double")
    hits = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _scaled(x: np.ndarray) -> np.ndarray:
    """Each row in double precision times a power of two that brings its largest component to between a half and one."""
    x = x.astype(np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row in double precision; the same two vectors give the same bits wherever they meet."""
    a, b = _scaled(a), _scaled(b)
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def _best(qid, q, ids, vecs, k):
    """Each query's ``k`` nearest ids of a block, ties to the smaller one."""
    s = _unit(q) @ _unit(vecs).T
    s[qid[:, None] == ids[None, :]] = -np.inf
    # An id may have several vectors, of which the nearest counts.
    most = k * int(np.unique(ids, return_counts=True)[1].max())
    if s.shape[1] > most:
        edge = -np.partition(-s, most - 1, axis=1)[:, most - 1 : most] - 1e-9
    else:
        edge = np.full((len(q), 1), -2.0)
    row, col = np.nonzero((s >= edge) & np.isfinite(s))
    score = np.concatenate([np.zeros(0), *(cosine(q[row[a : a + 65536]], vecs[col[a : a + 65536]]) for a in range(0, len(row), 65536))])
    order = np.lexsort((ids[col], -score, row))
    row, found, score = row[order], ids[col[order]], score[order]
    if most > k:
        once = np.sort(np.unique(np.stack([row, found]), axis=1, return_index=True)[1])
        row, found, score = row[once], found[once], score[once]
    start = np.searchsorted(row, np.arange(len(q)))
    near = np.arange(len(row)) - start[row] < k
    return pa.RecordBatch.from_arrays([pa.array(qid[row[near]]), pa.array(found[near]), pa.array(score[near])], names=["query_id", "vec_id", "score"])
