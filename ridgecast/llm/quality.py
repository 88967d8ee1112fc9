"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

Training takes the whole texts of all trusted labelled documents. A word's trigram (a, b, w) lies in the shard of its middle word b, and so do its bigram
(b, w) and its context (a, b): trigrams are counted per task, sent to their shards packed, and added up there, after which continuation counts, context totals and
discounts D1, D2, D3+ per order follow inside shards but for sums per word. A word with more occurrences than a shard should hold has several,
dealt by the word before it; its bigrams are added up over them and repeated in each. Words seen once in training fall into classes by shape, each spread evenly over
its words, so unseen words cost what a rare word costs.

A model's cost of a word is ``c1(w) + r1(b)``, corrected by what the bigram (b, w), the context (a, b) and the trigram (a, b, w) add where
the model has them. So scoring is a sharded count join: a document's trigrams are sent to the shards that hold what is added, and sums per document come back. Shards keep counts, not
weights, which take less room and give the weights in memory. Words (the ``MOST_WORDS`` most frequent that occur twice) and
the ``head`` most frequent trigrams, which would make hot shards, are looked up where the text is; a trigram is sent only if a bit table of the model's
bigrams has (b, w) or (a, b). Sums are whole numbers of ``1 / ONE``, the same in any order. Shards have a fixed number of words and are repeated for groups of chunks, so blobs grow in
proportion to the texts.

``perplexity`` is the document's: 10 to the mean negative log10 probability per word, ``score``. Chance moves the score of n words as much as
``sqrt((n + spread) / n)`` times that of a very long text (``spread`` was fitted on trusted documents), so a text's distance from its language's median
is divided by that, and the quantile ``q`` of these distances over trusted labelled documents that were not trained on is the language's threshold.
A language with fewer than ``least`` such documents, too few to tell the quantile, takes the one over all languages (the median from 30 on).
Of the labelled documents, crc32(doc_id as text) mod 10 deals 3 to 9 to training, 1 and 2 to thresholds, and 0 to nothing: figures are counted there.

Nulls and edges: a null, empty or blank text has score null and is kept: nothing speaks against it. A null language is one
language of its own. A null doc_id is scored and takes no label. Repeated rows are returned one for one; rows with one id and different texts
are judged each on its own. Labels of unknown documents, null labels and repeated labels do no harm. Without trusted text every document is
kept, its score null. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgecast.llm.batches import NOT_SPACE, STEP, U, by_group, chunks, doc_ids, mix, ranges, span_hashes, words
from ridgecast.llm.store import discard, materialize, shuffle_width, tidy

SHAPES = 16
#: A unit is a known word, a shape or the start of a text; an n-gram's key holds its units in so many bits each. In the place of a trigram's
#: first unit, a bigram has one of two marks: whether it is the context of a next word, or the text's last.
BITS = 21
UNIT = (1 << BITS) - 1
PAIR = (1 << 2 * BITS) - 1
INNER, LAST = UNIT << 2 * BITS, (UNIT - 1) << 2 * BITS
MOST_WORDS = (1 << BITS) - 32
#: Texts for which a shard is repeated: they ask for as much as it holds.
GROUP_BYTES = 64 << 20
#: Trained words of a shard, and the most rejected rows that are broadcast; beyond that texts are joined by exchange.
SHARD_LOG2 = 18
#: Bits of the table that tells which n-grams are worth asking for: 16 for each n-gram, 2 ** 27 at most. A fuller table lets more through, to no other result.
MOST_BITS_LOG2 = 27
BROADCAST_ROWS = 1_000_000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Trigrams that a task gathers before it sends them, counts that are told apart for the head, and the unit of sums that shards send back.
GATHER = 400_000
COUNTS = 1 << 14
ONE = 2.0**32
#: Chunks that a shard answers at once, and rows that Spark hands to Python at once: texts take memory on both sides.
AT_ONCE = 32
BATCH_ROWS = 2000
#: Documents are scored in so many passes, by hash of their texts, so that only the trigrams of one pass lie on the disks.
PASSES = 3


def shape(c, w) -> np.ndarray:
    """A small class of each word: first byte, last byte and whether lower-case letters and digits or marks occur."""
    first, last = c.data[w.start], c.data[w.end - 1]
    lower = np.concatenate([[0], np.cumsum((c.data >= 97) & (c.data <= 122))])
    has_lower = lower[w.end] > lower[w.start]
    upper = (first >= 65) & (first <= 90)
    plain_end = ((last >= 97) & (last <= 122)) | (last >= 128)
    stop = (last == 46) | (last == 44)
    return (upper * 1 + has_lower * 2 + np.where(plain_end, 0, np.where(stop, 4, 8))).astype(np.int64)


def _units(c, m: Model):
    """(words, unit of each word): its rank among known words, or its shape's place after them."""
    w = words(c, NOT_SPACE)
    h = span_hashes(c.data, w.start, w.end)
    s = shape(c, w) + len(m.known)
    if not len(m.known):
        return w, s
    at = np.minimum(np.searchsorted(m.known, h), len(m.known) - 1)
    return w, np.where(m.known[at] == h, m.unit[at], s)


def _contexts(w, units: np.ndarray, bos: int):
    """The unit before each word and the one before that; the start of a text is ``bos``."""
    n = len(units)
    b, a = np.full(n, bos), np.full(n, bos)
    if n > 1:
        same = w.doc[1:] == w.doc[:-1]
        b[1:][same] = units[:-1][same]
    if n > 2:
        same = w.doc[2:] == w.doc[:-2]
        a[2:][same] = units[:-2][same]
    return a, b


def keys(w, units: np.ndarray, bos: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: the unit before it, its bigram (without mark) and its trigram."""
    a, b = _contexts(w, units, bos)
    two = (b << BITS) | units
    return b, two, (a << 2 * BITS) | two


def _vocabulary(batches):
    for batch in batches:
        for c in chunks(batch.column("text"), 1 << 20):
            w = words(c)
            h, first, n = np.unique(span_hashes(c.data, w.start, w.end), return_index=True, return_counts=True)
            s = shape(c, w)[first]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(s), pa.array(n.astype(np.int64))], names=["h", "s", "n"])


def _sum_by(key: np.ndarray, n: np.ndarray):
    order = np.argsort(key)
    key = key[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[at], np.add.reduceat(n[order], at) if len(at) else n[:0]


def _trigrams(shared):
    """A task's trigrams and their counts, sorted, to their shards."""

    def flush(m, found):
        k, n = _sum_by(*(np.concatenate(x) for x in zip(*found, strict=True)))
        shard = m.shard_of(k)
        part, rows = [], []
        for p, at in by_group(shard):
            part.append(p)
            rows.append((_blob(np.diff(k[at], prepend=0)), _blob(n[at])))
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *(pa.array(x, pa.binary()) for x in zip(*rows, strict=True))], names=["part", "keys", "counts"])

    def run(batches):
        m = shared.value
        found, have = [], 0
        for batch in batches:
            for c in chunks(batch.column("text"), 1 << 20):
                w, u = _units(c, m)
                if not len(u):
                    continue
                found.append(np.unique(keys(w, u, m.start)[2], return_counts=True))
                have += len(found[-1][0])
                if have > GATHER:
                    yield flush(m, found)
                    found, have = [], 0
        if found:
            yield flush(m, found)

    return run


def _add_up(batches):
    """A shard's trigrams with their counts as one row, and how many there are of each count."""
    part, found = None, []
    for batch in batches:
        for i, p in enumerate(batch.column("part").to_pylist()):
            part = p
            found.append((np.cumsum(_unblob(batch.column("keys")[i], np.int64)), _unblob(batch.column("counts")[i], np.int64)))
    if part is None:
        return
    key, n = _sum_by(*(np.concatenate(x) for x in zip(*found, strict=True)))
    row = next(_pack([_numbers(part, key, n)]))
    yield row.append_column("times", pa.array([np.bincount(np.minimum(n, COUNTS - 1), minlength=COUNTS)], pa.list_(pa.int64())))


def _numbers(shard, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    shard = np.broadcast_to(np.asarray(shard, np.int32), len(key))
    return pa.RecordBatch.from_arrays([pa.array(shard), pa.array(key), pa.array(n.astype(np.float64)), pa.array(np.zeros(len(key)))], names=["shard", "key", "weight", "next"])


def _pairs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bigrams (b, w) of a shard's trigrams, and how many words they were seen after."""
    return np.unique(key & PAIR, return_counts=True)


def _often_pairs(shared):
    """The bigrams of words that have several shards, as far as each of these has them."""

    def run(batches):
        m = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                k, n = _pairs(unpack(batch.column("keys")[i], batch.column("weights")[i])[0])
                often = m.pieces(k >> BITS) > 1
                yield pa.RecordBatch.from_arrays([pa.array(k[often]), pa.array(n[often])], names=["k", "n"])

    return run


def _deal(shared):
    """Bigrams of words that have several shards, to each of these."""

    def run(batches):
        m = shared.value
        for batch in batches:
            k, n = batch.column("k").to_numpy(), batch.column("n").to_numpy()
            size = m.pieces(k >> BITS)
            at = np.repeat(np.arange(len(k)), size)
            piece = ranges(np.zeros(len(k), np.int64), size)
            yield _numbers(m.home(k[at] >> BITS, piece).astype(np.int32), k[at] | INNER, n[at])

    return run


BY_UNIT = ("n1", "n2", "n3", "n4", "pairs", "times", "before")


def _by_unit(shared):
    """Of each word: how many bigrams that it begins occur 1 to 4 times, how many there are, their occurrences, and how many bigrams it ends.

    Takes shards, of which words that have several are left out, or the bigrams of those (k, n).
    """

    def tell(k, n):
        b, bi = np.unique(k >> BITS, return_inverse=True)
        w, ended = np.unique(k & UNIT, return_counts=True)
        some = [np.bincount(bi[n == t], minlength=len(b)) for t in (1, 2, 3, 4)] + [np.bincount(bi, minlength=len(b)), np.bincount(bi, n, minlength=len(b))]
        cols = [np.concatenate([x.astype(np.int64), np.zeros(len(w), np.int64)]) for x in some] + [np.concatenate([np.zeros(len(b), np.int64), ended])]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([b, w])), *map(pa.array, cols)], names=["unit", *BY_UNIT])

    def run(batches):
        m = shared.value
        for batch in batches:
            if "k" in batch.schema.names:
                yield tell(batch.column("k").to_numpy(), batch.column("n").to_numpy())
                continue
            for i in range(batch.num_rows):
                k, n = _pairs(unpack(batch.column("keys")[i], batch.column("weights")[i])[0])
                one = m.pieces(k >> BITS) == 1
                yield tell(k[one], n[one])

    return run


def discounts(c: list[float]) -> list[float]:
    """Discount of a count of 1, 2, 3 or more from the counts of counts 1 to 4 (Chen and Goodman, 1998); fixed values where one is missing."""
    if min(c) == 0:
        return [0.5, 0.75, 0.9]
    y = c[0] / (c[0] + 2 * c[1])
    return [float(np.clip(k - (k + 1) * y * c[k] / c[k - 1], 0.05, k - 0.05)) for k in (1, 2, 3)]


def _less(n: np.ndarray, d) -> np.ndarray:
    """The discount of each count; nothing of none."""
    return np.concatenate([[0.0], d])[np.minimum(n, 3).astype(np.int64)]


ARRAYS = ("known", "cost", "rest", "head_key", "head_weight", "bits", "unit", "times", "p1", "rest2", "total2")


@dataclass
class Model:
    """What every task has: words, their costs, the head of the trigrams and the bit table of bigrams; of numbers by unit, those that a shard needs for its weights.

    ``most``: occurrences of a word that one shard takes.
    """

    known: np.ndarray
    cost: np.ndarray
    rest: np.ndarray
    most: float
    head_key: np.ndarray
    head_weight: np.ndarray
    bits: np.ndarray
    shards: int
    unit: np.ndarray | None = None
    times: np.ndarray | None = None
    p1: np.ndarray | None = None
    rest2: np.ndarray | None = None
    total2: np.ndarray | None = None
    less2: tuple = ()
    less3: tuple = ()

    def __getstate__(self):
        """Arrays go compressed: every executor and the driver keep a broadcast on disk."""
        return {x: (v.dtype.str, _blob(v)) if isinstance(v, np.ndarray) else v for x, v in self.__dict__.items()}

    def __setstate__(self, state):
        self.__dict__.update({x: _unblob(pa.scalar(v[1], pa.binary()), v[0]) if x in ARRAYS and v is not None else v for x, v in state.items()})

    def broadcast(self, spark: SparkSession):
        """(what texts are asked with, what shards need): no worker holds both."""
        none = np.zeros(0, np.int64)
        shard = replace(self, known=none, unit=none, cost=none, rest=none, head_key=none, head_weight=none, bits=none)
        return spark.sparkContext.broadcast(replace(self, p1=none, rest2=none, total2=none)), spark.sparkContext.broadcast(shard)

    @property
    def start(self) -> int:
        """The unit before a text."""
        return len(self.known) + SHAPES

    def pieces(self, b: np.ndarray) -> np.ndarray:
        """How many shards each word has."""
        return np.maximum(1, np.ceil(self.times[b] / self.most)).astype(np.int64)

    def home(self, b: np.ndarray, piece: np.ndarray) -> np.ndarray:
        return ((mix(b.view(np.uint64) ^ U(0x632BE59BD9B4E019)) % U(self.shards)).astype(np.int64) + piece) % self.shards

    def shard_of(self, key: np.ndarray) -> np.ndarray:
        """The shard of each trigram."""
        a, b = key >> 2 * BITS, key >> BITS & UNIT
        return self.home(b, (mix(a.view(np.uint64)) % self.pieces(b).view(np.uint64)).astype(np.int64))

    def has(self, key: np.ndarray) -> np.ndarray:
        key = mix(key.view(np.uint64))
        mask = U(64 * len(self.bits) - 1)
        test = lambda x: (self.bits[(x >> U(6)).astype(np.int64)] >> (x & U(63))) & U(1)
        return (test(key & mask) & test((key >> U(32)) & mask)).astype(bool)

    def of_head(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.head_key):
            return np.zeros(len(key), bool), np.zeros(len(key))
        at = np.minimum(np.searchsorted(self.head_key, key), len(self.head_key) - 1)
        hit = self.head_key[at] == key
        return hit, np.where(hit, self.head_weight[at], 0.0)


def trusted_ids(labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ids that thresholds are taken from, ids to train on): quality 1 and toxic not 1."""
    ok = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t")).where("q = 1 and t = 0").select(F.col("doc_id").cast("long").alias("doc_id"))
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(10))
    return ok.where(fold.isin(1, 2)), ok.where(fold >= 3)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder; neither its shuffle files nor many bytes stay on the disks."""
    with tidy(df.sparkSession):
        return materialize(df, name, "zstd")


def train(docs: DataFrame, ids: DataFrame, head: int) -> tuple[Model, DataFrame] | None:
    """(model, table of the shards, a row each) of the texts of ``ids``; None if they have fewer than 100 words."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    text = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).join(ids, "doc_id", "left_semi").select("text")
    text = kept(text, "trusted")
    vocab = text.mapInArrow(_vocabulary, "h long, s long, n long").groupBy("h").agg(F.first("s").alias("s"), F.sum("n").alias("n"))
    vocab = materialize(vocab, "vocabulary")
    # Of words seen once, and of those beyond the most that units have room for, only their number per shape is kept.
    by_shape = vocab.groupBy("s").agg(F.count("*").alias("words"), F.sum("n").alias("times")).collect()
    total = sum(r["times"] for r in by_shape)
    if total < 100:
        return None
    often = vocab.where("n > 1").orderBy(F.desc("n"), "h").limit(MOST_WORDS).select("h", "s", "n").toArrow()
    discard(vocab)
    h, s, n = (often[x].to_numpy() for x in ("h", "s", "n"))
    # Units by frequency, so that high bytes of n-grams are much alike.
    rank = np.lexsort((h, -n))
    h, s, n = h[rank].view("uint64"), s[rank], n[rank]
    unit = np.argsort(h)
    rare, times = -np.bincount(s, minlength=SHAPES), -np.bincount(s, n, minlength=SHAPES)
    for r in by_shape:
        rare[r["s"]] += r["words"]
        times[r["s"]] += r["times"]
    spread = np.log10(rare + 1.0)
    units = len(h) + SHAPES + 1
    shards = max(1, min(int(total) >> SHARD_LOG2, shuffle_width(spark)))
    none = np.zeros(0, np.int64)
    model = Model(h[unit], none, none, total / shards, none, none, none, shards, unit.astype(np.int32), np.concatenate([n, times, [0]]).astype(float))
    shared = sc.broadcast(model)
    shard = "shard int, keys binary, weights binary"
    counts = text.mapInArrow(_trigrams(shared), "part int, keys binary, counts binary").repartitionById(shards, F.col("part"))
    counts = kept(counts.mapInArrow(_add_up, f"{shard}, times array<long>"), "counts")
    discard(text)
    slim = counts.select("shard", "keys", "weights")
    told, rows, stored = slim.mapInArrow(_by_unit(shared), kind := "unit long, " + ", ".join(f"{x} long" for x in BY_UNIT)), slim, [counts]
    if (model.times > model.most).any():
        pairs = kept(slim.mapInArrow(_often_pairs(shared), "k long, n long").groupBy("k").agg(F.sum("n").alias("n")), "pairs")
        told = told.unionByName(pairs.mapInArrow(_by_unit(shared), kind))
        dealt = pairs.mapInArrow(_deal(shared), "shard int, key long, weight double, next double").repartitionById(shards, F.col("shard"))
        stored += [pairs, dealt := kept(dealt.mapInArrow(_pack, shard), "dealt")]
        rows = rows.unionByName(dealt)
    told = told.groupBy("unit").agg(*(F.sum(x).alias(x) for x in BY_UNIT)).toArrow()
    by = {x: np.zeros(units) for x in BY_UNIT}
    for x in BY_UNIT:
        by[x][told["unit"].to_numpy()] = told[x].to_numpy()
    of_count = sum(x.values.to_numpy() for x in counts.select("times").toArrow()["times"])

    # What discounts free goes to all words and one unseen one alike.
    n1 = by["before"]
    d1 = _less(n1, discounts([float((n1 == k).sum()) for k in range(1, 5)]))
    model.p1 = (n1 - d1) / n1.sum() + d1.sum() / n1.sum() / ((n1 > 0).sum() + 1)
    model.less2 = discounts([by[f"n{k}"].sum() for k in range(1, 5)])
    begins, (x, y, z) = by["pairs"] > 0, model.less2
    model.total2 = np.where(begins, by["times"], 1.0)
    model.rest2 = np.where(begins, (x * by["n1"] + y * by["n2"] + z * (by["pairs"] - by["n1"] - by["n2"])) / model.total2, 1.0)
    model.less3 = discounts([float(of_count[k]) for k in range(1, 5)])
    model.cost, model.rest = -np.log10(model.p1), -np.log10(model.rest2)
    model.cost[len(h) : model.start] += spread

    above = np.cumsum(of_count[::-1])[::-1]
    least = int(np.flatnonzero(above <= head)[0]) if above[-1] <= head else None
    n_pairs = int(by["pairs"].sum())
    del told, often, by
    numbers = sc.broadcast(replace(model, known=none, unit=none, cost=none, rest=none))
    packed = rows.repartitionById(shards, F.col("shard")).mapInArrow(_finish(numbers, least), f"{shard}, head_keys binary, head_weights binary")
    packed = kept(packed, "weights")
    discard(*stored)
    shared.destroy()
    numbers.destroy()
    found = packed.select("head_keys", "head_weights").toArrow()
    key, weight = (np.concatenate([np.zeros(0, t), *(_unblob(b, t) for b in found[x])]) for x, t in (("head_keys", np.int64), ("head_weights", np.float64)))
    order = np.argsort(key)
    model.head_key, model.head_weight = key[order], weight[order]
    packed_slim = packed.select("shard", "keys", "weights")
    packed_slim.stored_at = packed.stored_at
    # Bigrams without a mark, for which a quarter of the bits does.
    model.bits = bit_table(packed_slim.mapInArrow(_keys_of_pairs, "key long"), n_pairs // 4)
    return model, packed_slim


def _keys_of_pairs(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            key = unpack(batch.column("keys")[i], batch.column("weights")[i])[0]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(key[(key < LAST) | (key >= INNER)] & PAIR))], names=["key"])


class Shard:
    """What a shard's trigrams, bigrams and contexts add to the cost of a word; ``key``, ``n``: counts of its trigrams and, marked, of all bigrams of words that have several shards."""

    def __init__(self, key: np.ndarray, n: np.ndarray, m: Model):
        marked, tri = key >= INNER, key < LAST
        pair, times = _pairs(key[tri])
        one = m.pieces(pair >> BITS) == 1
        pair, times = np.concatenate([pair[one], key[marked] & PAIR]), np.concatenate([times[one], n[marked]])
        order = np.argsort(pair)
        self.pair, times = pair[order], times[order]
        b, w = self.pair >> BITS, self.pair & UNIT
        p2 = (times - _less(times, m.less2)) / m.total2[b] + m.rest2[b] * m.p1[w]
        self.own = -np.log10(p2) + np.log10(m.rest2[b]) + np.log10(m.p1[w])
        order = np.argsort(key[tri])
        self.key, n = key[tri][order], n[tri][order]
        context = self.key >> BITS
        first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(context) else np.zeros(0, np.int64)
        self.context = context[first]
        less = _less(n, m.less3)
        total, freed = (np.add.reduceat(x, first) if len(first) else np.zeros(0) for x in (n, less))
        rest = freed / np.maximum(total, 1)
        self.next = -np.log10(rest)
        size = np.diff(np.append(first, len(context)))
        total, rest, p2 = np.repeat(total, size), np.repeat(rest, size), p2[np.searchsorted(self.pair, self.key & PAIR)]
        self.weight = -np.log10((n - less) / total + rest * p2) + np.log10(rest) + np.log10(p2)
        self.n = n

    def added(self, key: np.ndarray) -> np.ndarray:
        """By each trigram asked for, with its bigram and its context."""
        out = np.zeros(len(key))
        hits = []
        for table, value, asked in ((self.pair, self.own, key & PAIR), (self.context, self.next, key >> BITS)):
            hits.append(np.zeros(len(key), bool))
            if len(table):
                at = np.minimum(np.searchsorted(table, asked), len(table) - 1)
                hits[-1] = table[at] == asked
                out += np.where(hits[-1], value[at], 0.0)
        both = np.flatnonzero(hits[0] & hits[1])
        at = np.minimum(np.searchsorted(self.key, key[both]), len(self.key) - 1)
        out[both] += np.where(self.key[at] == key[both], self.weight[at], 0.0)
        return out


def _finish(shared, least: int | None):
    """A shard as one row, and what its trigrams that occur ``least`` times or more add."""

    def run(batches):
        part, found = None, []
        for batch in batches:
            for i, p in enumerate(batch.column("shard").to_pylist()):
                part = p
                found.append(unpack(batch.column("keys")[i], batch.column("weights")[i]))
        if part is None:
            return
        key, n = (np.concatenate(x) for x in zip(*found, strict=True))
        shard = Shard(key, n, shared.value)
        head = shard.key[shard.n >= least] if least is not None else shard.key[:0]
        own = (key < LAST) | (key >= INNER)
        row = next(_pack([_numbers(part, key[own], n[own])]))
        yield row.append_column("head_keys", pa.array([_blob(head)], pa.binary())).append_column("head_weights", pa.array([_blob(shard.added(head))], pa.binary()))

    return run


def with_last(key: np.ndarray, weight: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, weight), sorted, with both keys of each bigram."""
    pair = key >= INNER
    key, weight = np.concatenate([key, key[pair] & PAIR | LAST]), np.concatenate([weight + after, weight[pair]])
    order = np.argsort(key)
    return key[order], weight[order]


def bit_table(table: DataFrame, n: int | None = None) -> np.ndarray:
    """Two bits for each key of ``table`` (key), both of a bigram's, among 16 or more as long as ``MOST_BITS_LOG2`` allows; tasks send tables of their own to the driver. ``n`` is their number, if it is known."""
    n = table.select(F.count("*") + F.count_if(F.col("key") >= INNER)).first()[0] if n is None else n
    log2 = min(MOST_BITS_LOG2, max(10, math.ceil(math.log2(16 * max(1, n)))))
    mask = U((1 << log2) - 1)

    def run(batches):
        bits = np.zeros((1 << log2) >> 6, np.uint64)
        for batch in batches:
            key = batch.column("key").to_numpy()
            if not len(key):
                continue
            x = mix(np.concatenate([key, key[key >= INNER] & PAIR | LAST]).view(np.uint64))
            at = np.sort(np.concatenate([x & mask, x >> U(32) & mask]))
            word = (at >> U(6)).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            bits[word[first]] |= np.bitwise_or.reduceat(U(1) << (at & U(63)), first)
        yield pa.RecordBatch.from_arrays([pa.array([_blob(bits)], pa.binary())], names=["bits"])

    # A table per task and no exchange: eight of 16 MB at most.
    bits = np.zeros((1 << log2) >> 6, np.uint64)
    for blob in table.coalesce(8).mapInArrow(run, "bits binary").toArrow()["bits"]:
        bits |= _unblob(blob, np.uint64)
    return bits


#: Kinds: 0 a shard (keys, weights), 1 a chunk's rows with what is known on the spot, 2 a chunk's trigrams (keys) and how many each row has (weights).
ROWS = "chunk long, doc_id array<long>, content array<long>, lang array<string>, n array<long>, cost array<double>"
ASKED = f"part int, kind int, {ROWS}, keys binary, weights binary"
ANSWERED = f"part int, {ROWS}, sums binary"


def _blob(x: np.ndarray) -> bytes:
    """``x`` compressed, the first bytes of all its numbers before the second ones, and so on: high bytes are much alike."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T
    return len(x).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unblob(scalar, dtype) -> np.ndarray:
    m = memoryview(scalar.as_buffer())
    n = int.from_bytes(m[:8], "little")
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(m[8:], n * size, codec="zstd"), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(n)


def _chunk_key(ids, contents) -> int:
    """Tells chunks apart; those alike in ids and texts, row by row, share it."""
    x = mix(contents.to_numpy().view(np.uint64)) + mix(doc_ids(ids).view(np.uint64) ^ U(0x2545F4914F6CDD1D)) * STEP[30]
    return int(np.bitwise_xor.reduce(mix(x + np.arange(len(x), dtype=np.uint64) * STEP[31])).view(np.int64))


def _ask(shared, groups: int):
    """Each chunk's trigrams to their shards, in the order of the text; what is known on the spot goes along."""

    def run(batches):
        m = shared.value
        for batch in batches:
            ids, contents, langs = batch.column("doc_id"), batch.column("content"), batch.column("lang")
            for c in chunks(batch.column("text"), 1 << 20):
                w, u = _units(c, m)
                a, b = _contexts(w, u, m.start)
                two = (b << BITS) | u
                key = (a << 2 * BITS) | two
                hit, weight = m.of_head(key)
                n = np.bincount(w.doc, minlength=c.n)
                known = np.bincount(w.doc, m.cost[u] + m.rest[b] + weight, minlength=c.n)
                far = np.flatnonzero(~hit)
                far = far[m.has(two[far]) | m.has(key[far] >> BITS) | (b[far] == m.start)]
                key, row = key[far], w.doc[far]
                mine = [x.slice(c.first, c.n) for x in (ids, contents, langs)]
                chunk = _chunk_key(*mine[:2])
                group = chunk % groups
                part, asked, sizes = [chunk // groups % m.shards * groups + group], [None], [None]
                for p, k in by_group(m.shard_of(key)):
                    part.append(p * groups + group)
                    asked.append(_blob(key[k]))
                    sizes.append(_blob(np.bincount(row[k], minlength=c.n).astype(np.int32)))
                once = lambda x: pa.ListArray.from_arrays(pa.array([0] + [c.n] * len(part), pa.int32()), x, mask=pa.array([False] + [True] * (len(part) - 1)))  # noqa: B023, E731
                cols = [pa.array([chunk] * len(part)), *map(once, (*mine, pa.array(n.astype(np.int64)), pa.array(known)))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int32()), pa.array([1] + [2] * (len(part) - 1), pa.int32()), *cols, pa.array(asked, pa.binary()), pa.array(sizes, pa.binary())],
                    names=["part", "kind", "chunk", "doc_id", "content", "lang", "n", "cost", "keys", "weights"],
                )

    return run


def _pack(batches):
    """A shard's n-grams as one row."""
    part, parts = None, []
    for batch in batches:
        if batch.num_rows:
            part = batch.column("shard")[0].as_py()
            parts.append([batch.column(x).to_numpy() for x in ("key", "weight", "next")])
    if part is None:
        return
    key, weight, after = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(key)
    key, weight, after = key[order], weight[order], after[order]
    # Steps from key to key; only bigrams, which come last, have a second number.
    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([_blob(np.diff(key, prepend=0))], pa.binary()), pa.array([_blob(np.concatenate([weight, after[key >= INNER]]))], pa.binary())], names=["shard", "keys", "weights"])


def unpack(keys, weights) -> tuple[np.ndarray, np.ndarray]:
    """(key, weight) of a row of ``_pack``, with both keys of each bigram."""
    key, found = np.cumsum(_unblob(keys, np.int64)), _unblob(weights, np.float64)
    after = np.zeros(len(key))
    after[key >= INNER] = found[len(key) :]
    return with_last(key, found[: len(key)], after)


def _answer(shared, buckets: int):
    """In a part: the shard comes first, then chunks; each row's sum goes to the chunk's bucket, as do the chunks' rows."""

    def run(batches):
        shard = None
        for batch in batches:
            kinds, chunk = batch.column("kind").to_numpy(), batch.column("chunk")
            for i in np.flatnonzero(kinds == 0):
                shard = Shard(*unpack(batch.column("keys")[int(i)], batch.column("weights")[int(i)]), shared.value)
            to = lambda x: pa.array(x.to_numpy() % buckets, pa.int32())
            own = batch.filter(pa.array(kinds == 1))
            if own.num_rows:
                yield pa.RecordBatch.from_arrays([to(own.column("chunk")), *(own.column(x) for x in ("chunk", "doc_id", "content", "lang", "n", "cost")), pa.nulls(own.num_rows, pa.binary())], names=[x.split()[0] for x in ANSWERED.split(", ")])
            asked = np.flatnonzero(kinds == 2)
            for at in range(0, len(asked), AT_ONCE):
                some = [int(i) for i in asked[at : at + AT_ONCE]]
                size = [_unblob(batch.column("weights")[i], np.int32) for i in some]
                key = np.concatenate([_unblob(batch.column("keys")[i], np.int64) for i in some])
                ends = np.cumsum([len(x) for x in size])
                found = np.zeros(len(key)) if shard is None else shard.added(key)
                total = np.rint(np.bincount(np.repeat(np.arange(ends[-1]), np.concatenate(size)), found, minlength=ends[-1]) * ONE).astype(np.int64)
                sums = pa.array([_blob(x) for x in np.split(total, ends[:-1])], pa.binary())
                mine = chunk.take(pa.array(some))
                none = [pa.nulls(len(some), pa.list_(t)) for t in (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.float64())]
                yield pa.RecordBatch.from_arrays([to(mine), mine, *none, sums], names=[x.split()[0] for x in ANSWERED.split(", ")])

    return run


def _sum_up(batches):
    """In a bucket: the rows of its chunks with their sums. Chunks alike are asked for as often as they occur."""
    own, sums = {}, {}
    for batch in batches:
        for i, chunk in enumerate(batch.column("chunk").to_pylist()):
            if batch.column("sums")[i].is_valid:
                x = _unblob(batch.column("sums")[i], np.int64)
                sums[chunk] = sums[chunk] + x if chunk in sums else x
            else:
                own.setdefault(chunk, []).append([batch.column(x)[i].values for x in ("doc_id", "content", "lang", "n", "cost")])
    for chunk, found in own.items():
        for ids, content, lang, n, cost in found:
            nll = cost.to_numpy() + (sums[chunk] / (ONE * len(found)) if chunk in sums else 0.0)
            yield pa.RecordBatch.from_arrays([ids, content, lang, n, pa.array(nll)], names=["doc_id", "content", "lang", "n_words", "nll"])


def perplexities(docs: DataFrame, model: Model, packed: DataFrame, shared=None) -> DataFrame:
    """Per row of ``docs`` (doc_id, content, lang, text): doc_id, content, lang, n_words, nll (in log10). ``shared``: what ``Model.broadcast`` gave, if it was called before."""
    spark = docs.sparkSession
    shards = model.shards
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    groups = max(1, min(shuffle_width(spark) // shards, -(-size // GROUP_BYTES)))
    asks, answers = model.broadcast(spark) if shared is None else shared
    packed = packed.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (x.split(" ") for x in ROWS.split(", "))]
    packed = packed.select((F.col("shard") * groups + F.col("group")).alias("part"), F.lit(0).alias("kind"), *none, "keys", "weights")
    asked = docs.mapInArrow(_ask(asks, groups), ASKED)
    dealt = asked.unionByName(packed).repartitionById(shards * groups, F.col("part")).sortWithinPartitions("kind")
    found = dealt.mapInArrow(_answer(answers, shards * groups), ANSWERED).repartitionById(shards * groups, F.col("part"))
    found = found.mapInArrow(_sum_up, "doc_id long, content long, lang string, n_words long, nll double")
    # Sums of the known part come in the order of the text; the last digits are cut.
    return found.withColumn("nll", F.round("nll", 7))


def content_of() -> Column:
    """Tells rows with one id apart."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")), F.col("lang").cast("string"))


def quality(docs: DataFrame, labels: DataFrame, head: int = 1 << 17, q: float = 0.995, spread: float = 150.0, least: int = 200) -> DataFrame:
    """Per row of ``docs``: doc_id, lang, content, n_words, score, perplexity, threshold, keep."""
    spark = docs.sparkSession
    rows = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(min(int(rows), BATCH_ROWS) if int(rows) > 0 else BATCH_ROWS))
    try:
        with tidy(spark):
            return _quality(docs, labels, head, q, spread, least)
    finally:
        spark.conf.set(ARROW_ROWS, rows)


def _quality(docs: DataFrame, labels: DataFrame, head: int, q: float, spread: float, least: int) -> DataFrame:
    fold, chosen = trusted_ids(labels)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), content_of().alias("content"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    trained = train(docs.withColumn("doc_id", F.col("doc_id").cast("long")), chosen, head)
    out = ["doc_id", "lang", "content", "n_words", "score", F.pow(F.lit(10.0), F.col("score")).alias("perplexity"), "threshold", F.coalesce(F.col("score") <= F.col("threshold"), F.lit(True)).alias("keep")]
    if trained is None:
        n = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), "")).cast("long")
        return slim.withColumns({"n_words": n, "score": F.lit(None).cast("double"), "threshold": F.lit(None).cast("double")}).select(out)
    model, packed = trained
    shared = model.broadcast(docs.sparkSession)
    scored = []
    for i in range(PASSES):
        some = slim.where(F.pmod(F.col("content"), F.lit(PASSES)) == i)
        scored.append(materialize(perplexities(some, model, packed, shared).withColumn("score", F.when(F.col("n_words") > 0, F.col("nll") / F.col("n_words"))), "scores"))
    scored = reduce(DataFrame.unionByName, scored)
    discard(packed)
    for x in shared:
        x.destroy()
    grain = F.grouping("lang").alias("all")

    def per_language(value, at, enough):
        """``at``-quantile of ``value`` of the documents for thresholds: (per language with enough of them, over all); languages are few, a row each."""
        got = fit.cube("lang").agg(F.percentile_approx(value, at, 10000).alias("v"), F.count("*").alias("k"), grain)
        got = materialize(got, "quantiles")
        return got.where((F.col("all") == 0) & (F.col("k") >= enough)).select(F.col("lang").alias("of"), "v"), F.lit(next((r["v"] for r in got.where("all = 1").collect()), None)).cast("double")

    def with_language(table, name, found, rest):
        return table.join(found.withColumnRenamed("v", name), F.col("lang").eqNullSafe(F.col("of")), "left").drop("of").withColumn(name, F.coalesce(name, rest))

    fit = scored.where("score is not null").join(fold, "doc_id", "left_semi")
    middle = per_language("score", 0.5, 30)
    wide = F.sqrt((F.col("n_words") + spread) / F.greatest("n_words", F.lit(1)))
    fit = with_language(fit, "middle", *middle).withColumn("distance", (F.col("score") - F.col("middle")) / wide)
    edge = per_language("distance", q, least)
    found = with_language(with_language(scored, "middle", *middle), "edge", *edge)
    threshold = F.when(F.col("n_words") > 0, F.col("middle") + F.col("edge") * wide)
    return found.withColumn("threshold", threshold).select(out)


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, each judged by its own text; rows without an id are judged too."""
    bad = quality(docs, labels, **options).where("not keep").select(F.col("content").alias("__content"), F.col("doc_id").alias("__id")).distinct()
    bad = kept(bad, "rejected")
    if bad.count() <= BROADCAST_ROWS:
        bad = F.broadcast(bad)
    marked = docs.withColumn("__row", content_of())
    return marked.join(bad, (F.col("__row") == F.col("__content")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__id")), "left_anti").select(docs.columns)
