"""N-gram Jaccard join by grouped prefixes.

A document's set holds its distinct five-word shingles. Two documents link when
``100 * |A & B| >= 80 * |A | B|``; the result names each document's connected component.

How it runs
1. One pass gives a row per document: set size and a 128-bit fingerprint (a, b) of the set. Documents with equal sets
   form one class and are handled once. Should two classes share ``a``, the pass is repeated with another salt, so ``a`` names a class.
2. A second pass deals every class's shingles to shards by hash, packed in blobs that a task gathers over many chunks. A shard counts
   each shingle and sends back only those that two classes or more hold, with the rank of their frequency. Shingles of at least 1/64
   of all documents, and classes of at least 1/64 of all rows, are few by construction (sizes add up), so they are
   broadcast and never meet in one shard. A shingle is a 56-bit hash: in sets of 300 shingles, one pair of documents in 10**12 has a
   chance meeting.
3. A class keeps its repeated shingles R, rarest first, if ``|R|`` can still reach the threshold. Shingles that
   no other class holds come first in the global order (by rank, then hash), so the prefix of a class is its
   unique shingles followed by the head of R. Classes with identical prefix and size form one group; prefix
   tokens are joined group by group under the size and position filters, then groups are expanded and members verified.
4. Only connectivity is asked for. Every prefix list is first verified against its smallest group (a star), and
   components are built. What is left are lists that hold several components: there, groups that are not of the list's largest component
   meet all groups of other components and similar size, pairs of groups pass the filters, and only then are expanded to members and
   verified in full. So near copies by the thousand cost a star, an outsider among them one pass over the list, and no
   candidate pair between components is skipped.

Nulls and edges: null or empty texts, and texts without words, have an empty set and link with nothing. A null
``doc_id`` ranks as the largest id and is returned as null. Repeated rows are equal sets, hence one component; each row
is returned. Other columns of the input are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgecast.llm.batches import LOWER, STEP, U, by_group, chunks, doc_ids, mix, pack56, ranges, span_hashes, unpack56, words
from ridgecast.llm.components import components
from ridgecast.llm.store import materialize, shuffle_width

#: A token is a shingle's hash of this many bits; with the rank of its frequency above, it fits a long.
TOKEN_BITS = 56
MOST_RANK = 127
#: Tokens that a task gathers before it sends them.
GATHER = 2_000_000
#: Share of all rows from which a token or a class is broadcast instead of dealt out.
HOT_SHARE = 64


def shingle_sets(c, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a chunk: (row of each token, token), sorted and distinct, and the set size of each row."""
    c.data = LOWER[c.data]
    w = words(c)
    h = span_hashes(c.data, w.start, w.end)
    count = np.bincount(w.doc, minlength=c.n)
    rows, toks = [], []
    if len(h) >= width:
        full = w.doc[: len(h) - width + 1] == w.doc[width - 1 :]
        s = np.zeros(len(h) - width + 1, np.uint64)
        for k in range(width):
            s += h[k : len(s) + k] * STEP[k]
        rows.append(w.doc[: len(s)][full])
        toks.append(mix(s[full]))
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        first = np.concatenate([[0], np.cumsum(count)])[short]
        s = count[short].astype(np.uint64) * STEP[63]
        for k in range(width - 1):
            has = count[short] > k
            s[has] += h[first[has] + k] * STEP[32 + k]
        rows.append(short)
        toks.append(mix(s))
    if not rows:
        z = np.zeros(0, np.int64)
        return z, z.astype(np.uint64), np.zeros(c.n, np.int64)
    row, token = np.concatenate(rows), np.concatenate(toks) >> U(64 - TOKEN_BITS)
    order = np.argsort(token)
    order = order[np.argsort(row[order].astype(np.uint16), kind="stable")]
    row, token = row[order], token[order]
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (token[1:] != token[:-1])])
    row, token = row[new], token[new]
    return row, token, np.bincount(row, minlength=c.n)


def fingerprints(row: np.ndarray, token: np.ndarray, size: np.ndarray, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that identify each row's set; 0 where it is empty."""
    a, b = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
    if len(row):
        at = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        a[row[at]] = np.add.reduceat(mix(token + U(1 + (salt << TOKEN_BITS))), at)
        b[row[at]] = np.add.reduceat(mix(token ^ U(0x5851F42D4C957F2D)), at)
    return a.view(np.int64), b.view(np.int64)


def _batch_chunks(batch: pa.RecordBatch):
    ids = doc_ids(batch.column("doc_id"))
    for c in chunks(batch.column("text")):
        yield ids[c.first : c.first + c.n], c


def _profile(width: int, salt: int):
    """Rows (doc_id, n, a, b) of documents, and rows (token, df) of tokens that are frequent in a chunk."""

    def run(batches):
        for batch in batches:
            for ids, c in _batch_chunks(batch):
                row, token, size = shingle_sets(c, width)
                a, b = fingerprints(row, token, size, salt)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(size.astype(np.int64)), pa.array(a), pa.array(b), pa.nulls(c.n, pa.int64()), pa.nulls(c.n, pa.int64())], names=["doc_id", "n", "a", "b", "token", "df"])
                t = np.sort(token)
                at = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]])) if len(t) else np.zeros(0, np.int64)
                df = np.diff(np.append(at, len(t)))
                often = df >= max(8, c.n / HOT_SHARE)
                k = int(often.sum())
                if k:
                    yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.array(t[at][often].astype(np.int64)), pa.array(df[often].astype(np.int64))], names=["doc_id", "n", "a", "b", "token", "df"])

    return run


def rank_of(df: np.ndarray) -> np.ndarray:
    """Eight ranks to a doubling of the frequency; the last one is for what is broadcast."""
    return np.minimum(8 * np.log2(df), MOST_RANK - 1).astype(np.uint8)


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where, how long) each run of equal values is."""
    at = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
    return at, np.diff(np.append(at, len(x)))


def _deal(width: int, shards: int, salt: int, heavy, owner):
    """Blobs: light tokens to their shard (kind 0), each class's size and heavy tokens to its bucket (kind 1)."""

    def flush(classes, far):
        part, kind, blob = [], [], []
        a, b, size, count, tokens = (np.concatenate(x) for x in zip(*classes, strict=True))
        start = np.cumsum(count) - count
        for p, r in by_group((mix(a.view(np.uint64)) % U(shards)).astype(np.int64)):
            mine = tokens[ranges(start[r], count[r])]
            part.append(p)
            kind.append(1)
            blob.append(np.array([len(r), len(mine)], "<i8").tobytes() + a[r].tobytes() + b[r].tobytes() + size[r].astype("<i4").tobytes() + count[r].astype("<i4").tobytes() + pack56(mine))
        row, token = (np.concatenate(x) for x in zip(*far, strict=True))
        for p, k in by_group((((token >> U(TOKEN_BITS - 32)) * U(shards)) >> U(32)).astype(np.int64)):
            at, many = _runs(row[k])
            part.append(p)
            kind.append(0)
            blob.append(np.array([len(at), len(k)], "<i8").tobytes() + a[row[k][at]].tobytes() + many.astype("<i4").tobytes() + pack56(token[k]))
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())], names=["part", "kind", "blob"])

    def run(batches):
        heavy_tokens = heavy.value
        hot_a, hot_owner = owner.value
        classes, far, rows, have = [], [], 0, 0
        for batch in batches:
            for ids, c in _batch_chunks(batch):
                row, token, size = shingle_sets(c, width)
                a, b = fingerprints(row, token, size, salt)
                take = size > 0
                order = np.lexsort((ids, a))
                take[order[np.concatenate([[False], a[order][1:] == a[order][:-1]])]] = False
                if len(hot_a):
                    at = np.minimum(np.searchsorted(hot_a, a), len(hot_a) - 1)
                    take &= (hot_a[at] != a) | (hot_owner[at] == ids)
                keep = take[row]
                row, token = (np.cumsum(take) - 1)[row[keep]], token[keep]
                at = np.minimum(np.searchsorted(heavy_tokens, token), len(heavy_tokens) - 1) if len(heavy_tokens) else None
                is_heavy = heavy_tokens[at] == token if at is not None else np.zeros(len(token), bool)
                live = int(take.sum())
                classes.append((a[take], b[take], size[take], np.bincount(row[is_heavy], minlength=live), token[is_heavy]))
                far.append((row[~is_heavy] + rows, token[~is_heavy]))
                rows += live
                have += len(token) + live
                if have > GATHER:
                    yield flush(classes, far)
                    classes, far, rows, have = [], [], 0, 0
        if classes:
            yield flush(classes, far)

    return run


def _count(shards: int):
    """In a shard: how many classes hold each token; sends those of two or more back to the classes' buckets."""

    def run(batches):
        owner, count, tokens, mine = [], [], [], None
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            through = np.flatnonzero(kinds == 1)
            if len(through):
                yield batch.take(pa.array(through))
            for i in np.flatnonzero(kinds == 0):
                mine = True
                m = memoryview(batch.column("blob")[int(i)].as_buffer())
                docs, n = (int(x) for x in np.frombuffer(m, "<i8", 2))
                owner.append(np.frombuffer(m, "<i8", docs, 16))
                count.append(np.frombuffer(m, "<i4", docs, 16 + 8 * docs))
                tokens.append(unpack56(m[16 + 12 * docs :], n))
        if mine is None:
            return
        token = np.concatenate(tokens)
        a = np.repeat(np.concatenate(owner), np.concatenate(count))
        del owner, count, tokens
        # A class that several tasks have sent holds a token once.
        order = np.argsort(a, kind="stable")
        order = order[np.argsort(token[order], kind="stable")]
        a, token = a[order], token[order]
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (a[1:] != a[:-1])])
        a, token = a[new], token[new]
        _, df = _runs(token)
        again = np.repeat(df > 1, df)
        rank, a, token = np.repeat(rank_of(df), df)[again], a[again], token[again]
        part, blob = [], []
        for p, k in by_group((mix(a.view(np.uint64)) % U(shards)).astype(np.int64)):
            k = k[np.argsort(a[k], kind="stable")]
            at, many = _runs(a[k])
            part.append(p)
            blob.append(np.array([len(at), len(k)], "<i8").tobytes() + a[k][at].tobytes() + many.astype("<i4").tobytes() + rank[k].tobytes() + pack56(token[k]))
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(np.full(len(part), 2, np.int32)), pa.array(blob, pa.binary())], names=["part", "kind", "blob"])

    return run


def _assemble(percent: int):
    """In a bucket: for each class that can reach the threshold, (a, b, n, u, r): r has its repeated tokens, rarest first."""

    def run(batches):
        ca, cb, cn, a, key = [], [], [], [], []
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            for i in range(batch.num_rows):
                m = memoryview(batch.column("blob")[i].as_buffer())
                docs, n = (int(x) for x in np.frombuffer(m, "<i8", 2))
                x = np.frombuffer(m, "<i8", docs, 16)
                at = 16 + 8 * docs
                if kinds[i] == 1:
                    ca.append(x)
                    cb.append(np.frombuffer(m, "<i8", docs, at))
                    cn.append(np.frombuffer(m, "<i4", docs, at + 8 * docs))
                    a.append(np.repeat(x, np.frombuffer(m, "<i4", docs, at + 12 * docs)))
                    key.append(unpack56(m[at + 16 * docs :], n) | U(MOST_RANK << TOKEN_BITS))
                else:
                    a.append(np.repeat(x, np.frombuffer(m, "<i4", docs, at)))
                    at += 4 * docs
                    rank = np.frombuffer(m, np.uint8, n, at).astype(np.uint64)
                    key.append(unpack56(m[at + n :], n) | (rank << U(TOKEN_BITS)))
        if not ca:
            return
        ca, cb, cn = np.concatenate(ca), np.concatenate(cb), np.concatenate(cn)
        # ``a`` names a class, and each was sent by one task or more.
        ca, order = np.unique(ca, return_index=True)
        cb, cn = cb[order], cn[order].astype(np.int64)
        a, key = np.concatenate(a), np.concatenate(key)
        cls = np.searchsorted(ca, a)
        order = np.lexsort((key, cls))
        cls, key = cls[order], key[order]
        if len(cls):
            first = np.concatenate([[True], (cls[1:] != cls[:-1]) | (key[1:] != key[:-1])])
            cls, key = cls[first], key[first]
        have = np.bincount(cls, minlength=len(ca))
        reach = np.flatnonzero((have > 0) & (100 * have >= percent * cn))
        if not len(reach):
            return
        ok = np.zeros(len(ca), bool)
        ok[reach] = True
        r = key[ok[cls]].view(np.int64)
        step = 2000
        starts = np.concatenate([[0], np.cumsum(have[reach])])
        for i in range(0, len(reach), step):
            j = min(i + step, len(reach))
            s = starts[i : j + 1]
            lists = pa.ListArray.from_arrays(pa.array((s - s[0]).astype(np.int32)), pa.array(r[s[0] : s[-1]]))
            k = reach[i:j]
            yield pa.RecordBatch.from_arrays([pa.array(ca[k]), pa.array(cb[k]), pa.array(cn[k]), pa.array(cn[k] - have[k]), lists], names=["a", "b", "n", "u", "r"])

    return run


def _linked(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Of pairs (x, y) of classes: those whose sets meet the threshold. Tokens of one class only cannot overlap."""
    x = classes.select(F.col("c").alias("x"), F.col("n").alias("nx"), F.col("r").alias("rx"))
    y = classes.select(F.col("c").alias("y"), F.col("n").alias("ny"), F.col("r").alias("ry"))
    both = F.size(F.array_intersect("rx", "ry")).cast("long")
    return pairs.join(x, "x").join(y, "y").withColumn("o", both).where(100 * F.col("o") >= percent * (F.col("nx") + F.col("ny") - F.col("o"))).select("x", "y", "o")


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, class_size."""
    spark: SparkSession = docs.sparkSession
    shards = shuffle_width(spark)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for salt in range(8):
        profile = materialize(slim.mapInArrow(_profile(width, salt), "doc_id long, n long, a long, b long, token long, df long"), "sets")
        rows = profile.where("token is null").select("doc_id", "n", "a", "b")
        by_class = materialize(rows.where("n > 0").groupBy("a", "b").agg(F.min("doc_id").alias("c"), F.count("*").alias("members")), "sizes")
        if by_class.groupBy("a").count().where("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("different sets share a fingerprint under every salt")
    total = rows.count()
    least = max(8, total // HOT_SHARE)
    # Both lists are short by proof: document frequencies add up to the sum of set sizes, class sizes to the rows.
    hot_tokens = profile.where("token is not null").groupBy("token").agg(F.sum("df").alias("df")).where(F.col("df") >= least).select("token").collect()
    hot_classes = by_class.where(F.col("members") >= least).select("a", F.col("c").alias("owner")).collect()
    heavy_tokens = np.sort(np.array([r["token"] for r in hot_tokens], np.int64).view(np.uint64))
    hot_classes.sort(key=lambda r: r["a"])
    heavy = spark.sparkContext.broadcast(heavy_tokens)
    owner = spark.sparkContext.broadcast((np.array([r["a"] for r in hot_classes], np.int64), np.array([r["owner"] for r in hot_classes], np.int64)))
    blob = "part int, kind int, blob binary"
    dealt = slim.mapInArrow(_deal(width, shards, salt, heavy, owner), blob).repartitionById(shards, F.col("part"))
    back = dealt.mapInArrow(_count(shards), blob).repartitionById(shards, F.col("part"))
    found = back.mapInArrow(_assemble(percent), "a long, b long, n long, u long, r array<long>")
    classes = materialize(found.join(by_class, ["a", "b"]).select("c", "n", "u", "r"), "classes")

    # Prefix: n - ceil(percent * n / 100) + 1 tokens, of which u are held by no other class.
    length = F.expr(f"cast(n - (({percent} * n + 99) div 100) + 1 - u as int)")
    prefixed = classes.where(length > 0).select("c", "n", "u", F.slice("r", 1, length).alias("prefix"))
    prefixed = materialize(prefixed, "prefixes")
    same = prefixed.groupBy("n", "u", "prefix").agg(F.min("c").alias("g"))
    member = materialize(prefixed.join(same, ["n", "u", "prefix"]), "groups")
    groups = member.where("c = g")
    entries = groups.select(F.col("g"), "n", "u", F.posexplode("prefix").alias("i", "t"))
    entries = entries.select("g", "n", "t", (F.col("u") + F.col("i")).alias("at"))
    # One list per token and size octave: a star needs a centre of similar size.
    octave = F.floor(F.log(1.25, F.col("n").cast("double")))
    listed = entries.withColumn("octave", octave)
    centre = listed.groupBy("t", "octave").agg(F.min(F.struct("g", "n")).alias("m"), F.count("*").alias("k")).where("k > 1")
    small = F.least("n", F.col("m.n")) * 100 >= F.greatest("n", F.col("m.n")) * percent
    stars = listed.join(centre, ["t", "octave"]).where((F.col("g") != F.col("m.g")) & small).select(F.col("m.g").alias("x"), F.col("g").alias("y")).distinct()
    # Expand groups: each member against the centre's first member, and against its own group's first member.
    spread = stars.join(member.select(F.col("g").alias("y"), F.col("c")), "y").select("x", F.col("c").alias("y"))
    within = member.where("c != g").select(F.col("g").alias("x"), F.col("c").alias("y"))
    first = materialize(_linked(spread.unionByName(within).distinct(), classes, percent), "links")
    label = components(first.select("x", "y"))

    # What is left: lists in which groups of several components meet. A group may have members in several.
    named = member.select("c", "g").join(label.select(F.col("node").alias("c"), "component"), "c", "left").select("g", "c", F.coalesce("component", "c").alias("component"))
    named = materialize(named, "named")
    per = entries.join(named.select("g", "component").distinct(), "g").select("t", "g", "n", "at", "component")
    sums = per.groupBy("t", "component").agg(F.count("*").alias("k"))
    open_lists = sums.groupBy("t").agg(F.max_by("component", F.struct("k", "component")).alias("largest"), F.count("*").alias("components")).where("components > 1").select("t", "largest")
    per = materialize(per.join(open_lists, "t").withColumn("octave", octave.cast("int")), "open")
    # All groups but those of the largest component look for groups of other components, of their octave of size or the next.
    x = per.where("component != largest").select("t", F.explode(F.expr("sequence(octave - 1, octave + 1)")).alias("octave"), F.col("g").alias("x"), F.col("n").alias("nx"), F.col("at").alias("ax"), F.col("component").alias("cx"))
    y = per.select("t", "octave", F.col("g").alias("y"), F.col("n").alias("ny"), F.col("at").alias("ay"), F.col("component").alias("cy"), (F.col("component") == F.col("largest")).alias("big"))
    sizes = F.least("nx", "ny") * 100 >= F.greatest("nx", "ny") * percent
    need = F.expr(f"({percent} * (nx + ny) + {99 + percent}) div {100 + percent}")
    most = F.least(F.col("nx") - F.col("ax"), F.col("ny") - F.col("ay"))
    once = F.col("big") | (F.col("cx") < F.col("cy"))
    rest = x.join(y, ["t", "octave"]).where((F.col("cx") != F.col("cy")) & once & sizes & (most >= need)).select("x", "cx", "y", "cy").distinct()
    rest = rest.join(named.select(F.col("g").alias("x"), F.col("component").alias("cx"), F.col("c").alias("mx")), ["x", "cx"]).join(named.select(F.col("g").alias("y"), F.col("component").alias("cy"), F.col("c").alias("my")), ["y", "cy"])
    rest = rest.select(F.col("mx").alias("x"), F.col("my").alias("y")).distinct()
    if not per.isEmpty():
        more = materialize(_linked(rest, classes, percent), "links").select("x", "y")
        if not more.isEmpty():
            label = components(label.select(F.col("component").alias("x"), F.col("node").alias("y")).unionByName(more))
    label = label.select(F.col("node").alias("c"), "component")

    named = by_class.join(label, "c", "left").select("a", "b", F.coalesce("component", "c").alias("component"), "members")
    out = rows.join(named, ["a", "b"], "left")
    top = F.lit(2**63 - 1)
    return out.select(
        F.nullif("doc_id", top).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.nullif(F.coalesce("component", "doc_id"), top).alias("component_id"),
        F.coalesce("members", F.lit(1)).alias("class_size"),
    )


def keep_one_per_component(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose id is their component's smallest, one for each such id; rows without an id all stay."""
    found = jaccard_components(docs, width, percent)
    keep = found.where("doc_id = component_id").select("doc_id")
    one = docs.where("doc_id is not null").join(keep, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return one.select(docs.columns).unionByName(docs.where("doc_id is null"))
