"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

Tokens are words (runs of non-space characters, A-Z in lower case) and one end per text. The base gives each token
``(c + 0.1) / (N + 0.1 * (V + 1))`` from exact counts over all training texts. The model predicts a token's unit: frequent words are units of
their own, all other words fall into a few units by hash. Units are leaves of a tree with 16 branches per node,
``P(unit | context)`` is the product of ``P(branch | node, context)`` down the tree, each a softmax over hashed features of the context: the
word before, the two words before, and the word before that alone (a skip). Within a unit, words keep the base's proportions, so the
model's probabilities add up to what the base's do, and the score of a text is the base's plus what the context adds.

The model grows with the corpus: words of a count of 100 or more (less in small corpora) are units, up to 65,520 in a tree of four levels;
the rows of a level's hashed weights double as the training tokens do, from 2**15 to 2**18. Both are broadcast, and these two bounds are
where growth ends; counts and the base have no bound.

Counts are combined per task, then summed in shards by word; a text's rare words are sent to the shards with their
number in the text, and sums per text come back, so no table of all words is ever broadcast. Weights are trained by rounds of distributed
updates. Every round takes a share of the training texts by hash of id, so each is in exactly one, and deals it by hash of id to groups of about
4 million tokens; every group takes gradient steps (Adagrad, a rate per row) from the common weights over its texts in the order of their ids, and the
changes are averaged, weight by weight over the groups that made them, in the order of groups. So the result does not depend on how the table is
partitioned. Scoring runs over numpy batches of feature indices.

Nulls and edges: a null or empty text is its end alone. A null doc_id is neither learned from nor held out. Repeated rows
are learned and returned one for one. Without training texts every token has base probability 1 and the model adds nothing. Other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgecast.llm.batches import LOWER, STEP, U, by_group, chunks, doc_ids, mix, span_hashes, words
from ridgecast.llm.language import held_out
from ridgecast.llm.store import materialize, shuffle_width

END = U(0x2545F4914F6CDD1D)
BEGIN = U(0x6C62272E07BB0142)
#: Branches of a node, units that share the rare words, and the most words that are units of their own.
BITS = 4
BRANCHES, RARE = 1 << BITS, 16
MOST_UNITS = BRANCHES**4 - RARE
#: Training tokens of a group and round, and rare words that a task gathers before it sends them.
GROUP_TOKENS = 4_000_000
GATHER = 1_500_000
BLOB = "part int, kind int, blob binary"
TOP = 2**63 - 1


def tokens(c) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of all tokens of a chunk in order, each row's end last."""
    c.data = LOWER[c.data]
    w = words(c)
    h = span_hashes(c.data, w.start, w.end)
    n = np.bincount(w.doc, minlength=c.n)
    row = np.repeat(np.arange(c.n), n + 1)
    out = np.full(len(row), END)
    out[np.arange(len(h)) + w.doc] = h
    return row, out


def _sum_by(key: np.ndarray, n: np.ndarray):
    order = np.argsort(key)
    k = key[order]
    at = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[at], np.add.reduceat(n[order], at) if len(at) else n[:0]


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return (((h >> U(32)) * U(shards)) >> U(32)).astype(np.int64)


def _zip(*parts: bytes) -> bytes:
    raw = b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unzip(blob) -> memoryview:
    m = memoryview(blob.as_buffer())
    return memoryview(pa.decompress(m[8:], int.from_bytes(m[:8], "little"), codec="zstd"))


def _rows(part, kind, blob):
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([kind] * len(part), pa.int32()), pa.array(blob, pa.binary())], names=["part", "kind", "blob"])


def _count(shards: int):
    """Word counts of a task's training texts, dealt to shards."""

    def flush(h, n):
        h, n = _sum_by(np.concatenate(h), np.concatenate(n))
        cut = np.searchsorted(shard_of(h, shards), np.arange(shards + 1))
        to = np.flatnonzero(np.diff(cut))
        return _rows(to, 0, [_zip(np.array([cut[p + 1] - cut[p]], "<i8").tobytes(), h[cut[p] : cut[p + 1]].tobytes(), n[cut[p] : cut[p + 1]].astype("<i8").tobytes()) for p in to])

    def run(batches):
        hs, ns, have = [], [], 0
        for batch in batches:
            for c in chunks(batch.column("text")):
                h, n = np.unique(tokens(c)[1], return_counts=True)
                hs.append(h)
                ns.append(n)
                have += len(h)
                if have > 1_500_000:
                    yield flush(hs, ns)
                    hs, ns, have = [], [], 0
        if have:
            yield flush(hs, ns)

    return run


def _read_counts(m):
    n = int(np.frombuffer(m, "<i8", 1)[0])
    return np.frombuffer(m, "<u8", n, 8), np.frombuffer(m, "<i8", n, 8 + 8 * n)


def rare_unit(h: np.ndarray) -> np.ndarray:
    """Which of the units for rare words each word would belong to."""
    return (h % U(RARE)).astype(np.int64)


def _add_up(batches):
    hs, ns, own = [], [], None
    for batch in batches:
        for part, blob in zip(batch.column("part").to_pylist(), batch.column("blob"), strict=True):
            own = part
            h, n = _read_counts(_unzip(blob))
            hs.append(h)
            ns.append(n)
    if own is None:
        return
    h, n = _sum_by(np.concatenate(hs), np.concatenate(ns))
    unit = rare_unit(h)
    yield pa.RecordBatch.from_arrays(
        [pa.array([own], pa.int32()), pa.array([len(h)]), pa.array([int(n.sum())]), pa.array([np.bincount(unit, minlength=RARE).tolist()], pa.list_(pa.int64())), pa.array([np.bincount(unit, n, minlength=RARE).astype(np.int64).tolist()], pa.list_(pa.int64())), pa.array([_zip(np.array([len(h)], "<i8").tobytes(), h.tobytes(), n.tobytes())], pa.binary())],
        names=["part", "types", "tokens", "unit_types", "unit_tokens", "blob"],
    )


def _heavy(least: int):
    def run(batches):
        for batch in batches:
            for blob in batch.column("blob"):
                h, n = _read_counts(_unzip(blob))
                k = n >= least
                yield pa.RecordBatch.from_arrays([pa.array(h[k].view(np.int64)), pa.array(n[k])], names=["h", "n"])

    return run


def levels_for(words: int) -> int:
    """Levels of the tree: units fill a quarter of its leaves at least, two levels at least."""
    levels = 2
    while levels < 4 and 4 * (words + RARE) >= BRANCHES ** (levels + 1):
        levels += 1
    return levels


class Vocabulary:
    """Totals, frequent words with counts, and what unit each word belongs to with the unit's base probability."""

    def __init__(self, heavy_h, heavy_n, types, total, unit_types, unit_tokens):
        order = np.argsort(heavy_h)
        self.h, self.n, self.types, self.total = heavy_h[order], heavy_n[order], types, total
        self.levels = levels_for(len(self.h))
        leaves = BRANCHES**self.levels
        self.first_rare = min(len(self.h), leaves - RARE)
        whole = total + 0.1 * (types + 1)
        top = np.lexsort((self.h, -self.n))[: self.first_rare]
        rare = rare_unit(self.h)
        mass = np.zeros(leaves)
        mass[self.first_rare : self.first_rare + RARE] = unit_tokens + 0.1 * unit_types + 0.1 / RARE
        np.subtract.at(mass, self.first_rare + rare[top], self.n[top] + 0.1)
        self.unit = self.first_rare + rare
        self.unit[top] = np.arange(len(top))
        mass[: len(top)] = self.n[top] + 0.1
        mass[: self.first_rare + RARE] = np.maximum(mass[: self.first_rare + RARE] / whole, 1e-12)
        mass /= mass.sum()
        log = lambda x: np.where(x > 0, np.log(np.maximum(x, 1e-300)), -1e30)
        self.log_unit = log(mass).astype(np.float32)
        #: Of each level, for every node its branches' log probabilities without context; leaves that no unit has are out of reach.
        self.bias = []
        for k in range(self.levels):
            by = mass.reshape(BRANCHES ** (k + 1), -1).sum(axis=1).reshape(-1, BRANCHES)
            self.bias.append((log(by) - np.where(by.sum(axis=1) > 0, log(by.sum(axis=1)), 0)[:, None]).astype(np.float32))

    def path(self, unit: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(node, branch) of each unit on each level."""
        up = [unit >> BITS * (self.levels - k) for k in range(self.levels + 1)]
        return [(up[k], up[k + 1] & BRANCHES - 1) for k in range(self.levels)]

    def look_up(self, h):
        """(place among frequent words or -1, unit)"""
        rare = self.first_rare + rare_unit(h)
        if not len(self.h):
            return np.full(len(h), -1), rare
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        hit = self.h[at] == h
        return np.where(hit, at, -1), np.where(hit, self.unit[at], rare)


def features(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Hashes of the context features of every token: word before, two before, the second alone."""
    one, two = np.full(len(h), BEGIN), np.full(len(h), BEGIN)
    if len(h) > 1:
        same = row[1:] == row[:-1]
        one[1:][same] = h[:-1][same]
    if len(h) > 2:
        same = row[2:] == row[:-2]
        two[2:][same] = h[:-2][same]
    return np.stack([mix(one * STEP[10]), mix(one * STEP[11] + two * STEP[12]), mix(two * STEP[13])], axis=1)


def rows_log2(tokens: int) -> int:
    return int(np.clip(max(1, tokens).bit_length() - 11, 15, 18))


class Weights:
    """A table of hashed rows per level."""

    def __init__(self, levels: int, log2: int, tables=None):
        self.log2 = log2
        self.tables = [np.zeros((1 << log2, BRANCHES), np.float32) for _ in range(levels)] if tables is None else tables

    def copy(self) -> Weights:
        return Weights(len(self.tables), self.log2, [t.copy() for t in self.tables])

    def index(self, f: np.ndarray, level: int, node: np.ndarray) -> np.ndarray:
        """Rows of the features ``f`` (tokens x features) at a node."""
        own = mix(f + (node.astype(np.uint64) * STEP[20] + STEP[21 + level])[:, None])
        return (own & U((1 << self.log2) - 1)).astype(np.int64)

    def forward(self, v: Vocabulary, f: np.ndarray, unit: np.ndarray):
        """Per level: rows, branch taken, scores of all branches of the node, their exponentials and the sum of these."""
        for k, (node, branch) in enumerate(v.path(unit)):
            at = self.index(f, k, node)
            t = self.tables[k]
            x = _take(t, at[:, 0])
            x += _take(t, at[:, 1])
            x += _take(t, at[:, 2])
            x += _take(v.bias[k], node) if k else v.bias[0]
            x -= _top(x)
            e = np.exp(x)
            yield at, branch, x, e, e @ _ONES

    def log_prob(self, v: Vocabulary, f: np.ndarray, unit: np.ndarray) -> np.ndarray:
        out = np.zeros(len(unit), np.float32)
        for _, branch, x, _, total in self.forward(v, f, unit):
            out += np.take(x.ravel(), _taken(branch)) - np.log(total)
        return out


_ONES = np.ones(BRANCHES, np.float32)


def _whole(table: np.ndarray) -> np.ndarray:
    """Each row of ``table`` as one item, which numpy moves at once."""
    return table.view(f"V{table.itemsize * table.shape[1]}").ravel()


def _take(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return _whole(table).take(rows, mode="clip").view(table.dtype).reshape(len(rows), table.shape[1])


def _taken(branch: np.ndarray) -> np.ndarray:
    """Where each row's branch is among the numbers of all rows."""
    return np.arange(0, BRANCHES * len(branch), BRANCHES) + branch


def _top(x: np.ndarray) -> np.ndarray:
    """The largest of every row, by halves: quicker than a reduction over so short an axis."""
    while x.shape[1] > 1:
        half = x.shape[1] // 2
        x = np.maximum(x[:, :half], x[:, half:])
    return x


def _step(weights, total, index, grad, rate):
    """An Adagrad step on the rows of ``index`` (tokens x features), each with its token's gradient; a row has one rate, by its mean square."""
    flat = index.ravel()
    # Row and place in one number: its plain sort is quicker than a stable one by row.
    bits = len(flat).bit_length()
    small = np.uint32 if len(weights) << bits <= 1 << 32 else np.uint64
    key = (flat.astype(small) << small(bits)) | np.arange(len(flat), dtype=small)
    key.sort()
    f, order = key >> small(bits), (key & small((1 << bits) - 1)).astype(np.int64)
    at = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]]))
    r, size, token = f[at].astype(np.int64), np.diff(np.append(at, len(f))), order // index.shape[1]
    g = _take(grad, token[at])
    # Most rows occur once in a batch; only the others need sums.
    again = np.flatnonzero(size > 1)
    if len(again):
        ends = np.cumsum(size[again])
        g[again] = np.add.reduceat(_take(grad, token[np.repeat(size > 1, size)]), ends - size[again], axis=0)
    now = np.take(total, r) + np.einsum("ij,ij->i", g, g) / BRANCHES
    total[r] = now
    g *= (-rate / np.sqrt(now + 1e-2))[:, None].astype(g.dtype)
    g += _take(weights, r)
    np.put(_whole(weights), r, _whole(g))


BLOCKS = 8


def _block(part: int, level: int, group: int, used: np.ndarray, count: np.ndarray, total: np.ndarray):
    """Rows of a block: which are used, by how many groups (nothing: one, and changes in 16 bits), and changes."""
    one = not len(count)
    return _rows([part], level, [_zip(np.array([group, len(used), one], "<i8").tobytes(), np.packbits(used).tobytes(), count.astype("<f4").tobytes(), total.astype("<f2" if one else "<f4").tobytes())])


def _read_block(m):
    """(group, rows of the block that are used, counts, changes)"""
    group, n, one = (int(x) for x in np.frombuffer(m, "<i8", 3))
    rows = np.flatnonzero(np.unpackbits(np.frombuffer(m, np.uint8, -(-n // 8), 24), count=n))
    m = m[24 + -(-n // 8) :]
    if one:
        return group, rows, np.ones(len(rows), np.float32), np.frombuffer(m, "<f2").reshape(-1, BRANCHES).astype(np.float32)
    return group, rows, np.frombuffer(m, "<f4", len(rows)), np.frombuffer(m, "<f4", offset=4 * len(rows)).reshape(-1, BRANCHES)


def learn(v: Vocabulary, w: Weights, sums: list[np.ndarray], c, rate: float, batch_size: int = 2048) -> None:
    """Gradient steps on ``w`` over a chunk of texts; ``sums`` are the squares of the gradients so far."""
    row, h = tokens(c)
    _, unit = v.look_up(h)
    f = features(row, h)
    for a in range(0, len(h), batch_size):
        k = slice(a, a + batch_size)
        for level, (at, branch, _, p, total) in enumerate(w.forward(v, f[k], unit[k])):
            p /= total[:, None]
            p.ravel()[_taken(branch)] -= 1
            _step(w.tables[level], sums[level], at, p, rate)


def _train(vocab, weights, rate: float, per: int, parts: int):
    """From the common weights, steps over a group's texts; yields its changes in blocks of rows, dealt to its family of ``per`` groups."""

    def changes(v, common, group, batches):
        w = common.copy()
        sums = [np.zeros(len(t)) for t in w.tables]
        for texts in batches:
            for c in chunks(texts):
                learn(v, w, sums, c, rate)
        # Block p has every row r with r % BLOCKS == p.
        for level, (new, old) in enumerate(zip(w.tables, common.tables, strict=True)):
            for p in range(BLOCKS):
                used = sums[level][p::BLOCKS] > 0
                yield _block(p * parts + group // per, level, group, used, np.zeros(0), (new[p::BLOCKS] - old[p::BLOCKS])[used])

    def run(batches):
        v, common = vocab.value, weights.value

        def pieces():
            for batch in batches:
                g = batch.column("group").to_numpy()
                edge = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else []
                for a, b in zip(edge, [*edge[1:], len(g)], strict=True):
                    yield int(g[a]), batch.column("text").slice(a, b - a)

        for group, texts in groupby(pieces(), key=lambda x: x[0]):
            yield from changes(v, common, group, (t for _, t in texts))

    return run


def _combine(log2: int, parts: int):
    """Adds up the blocks of a part row by row, in the order of groups; ``parts`` families of a block become one."""

    def run(batches):
        have: dict[int, list] = {}
        for batch in batches:
            for part, level, blob in zip(batch.column("part").to_pylist(), batch.column("kind").to_pylist(), batch.column("blob"), strict=True):
                m = memoryview(blob.as_buffer())
                have.setdefault((part, level), []).append((_read_block(_unzip(blob))[0], bytes(m)))
        for (part, level), blocks in have.items():
            n, x = np.zeros((1 << log2) // BLOCKS, np.float32), np.zeros(((1 << log2) // BLOCKS, BRANCHES), np.float32)
            for _, raw in sorted(blocks, key=lambda b: b[0]):
                _, r, k, change = _read_block(_unzip(pa.scalar(raw, pa.binary())))
                n[r] += k
                x[r] += change
            used = n > 0
            yield _block(part // parts, level, part % parts, used, n[used], x[used])

    return run


def train(texts: DataFrame, vocab, total: int, rounds: int, rate: float) -> Weights:
    """``rounds`` rounds of updates that deal out all ``texts`` (doc_id, text; ``total`` tokens) among them, by hash of id."""
    sc, width = texts.sparkSession.sparkContext, shuffle_width(texts.sparkSession)
    groups = max(1, round(total / rounds / GROUP_TOKENS))
    per = math.isqrt(groups)
    parts = -(-groups // per)
    log2 = rows_log2(total)
    w = Weights(vocab.value.levels, log2)
    spread = F.xxhash64("doc_id")
    dealt = texts.withColumn("group", F.pmod(F.shiftright(spread, 20), F.lit(groups)).cast("int"))
    for r in range(rounds):
        common = sc.broadcast(w)
        part = dealt.where(F.pmod(spread, F.lit(rounds)) == r).repartitionById(groups, F.col("group")).sortWithinPartitions("group", spread, "doc_id", "text").select("group", "text")
        # Every group's changes meet those of its family first, then families meet: no task reads what all groups have made.
        made = part.mapInArrow(_train(vocab, common, rate, per, parts), BLOB).repartition(min(width, BLOCKS * parts), "part").mapInArrow(_combine(log2, parts), BLOB)
        for b in made.repartition(BLOCKS, "part").mapInArrow(_combine(log2, 1), BLOB).collect():
            _, rows, n, x = _read_block(_unzip(pa.scalar(bytes(b["blob"]), pa.binary())))
            w.tables[b["kind"]][b["part"] + BLOCKS * rows] += x / n[:, None]
        common.unpersist()
    return w


def _measure(shards: int, vocab, weights):
    """Rare words of each text to their shards (kind 1); length, base over frequent words and what the model adds to the text's bucket (kind 2).

    A task gathers many chunks before it sends, so that blobs are few and large.
    """

    def flush(own, far):
        part, kind, blob = [], [], []
        key, ids, n, known, part_sum, gain = (np.concatenate(x) for x in zip(*own, strict=True))
        for p, k in by_group((mix(key) % U(shards)).astype(np.int64)):
            part.append(p)
            kind.append(2)
            blob.append(_zip(np.array([len(k)], "<i8").tobytes(), key[k].tobytes(), ids[k].tobytes(), n[k].astype("<i8").tobytes(), known[k].astype("<i8").tobytes(), part_sum[k].tobytes(), gain[k].tobytes()))
        rr, rh, times = (np.concatenate(x) for x in zip(*far, strict=True))
        for p, k in by_group(shard_of(rh, shards)):
            r = rr[k]
            e = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
            part.append(p)
            kind.append(1)
            blob.append(_zip(np.array([len(e), len(k)], "<i8").tobytes(), key[r[e]].tobytes(), np.diff(np.append(e, len(r))).astype("<i4").tobytes(), rh[k].tobytes(), times[k].astype("<i4").tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())], names=["part", "kind", "blob"])

    def run(batches):
        v, w = vocab.value, weights.value
        logs = np.log10(v.n + 0.1)
        own, far, rows, size = [], [], 0, 0
        for batch in batches:
            ids = doc_ids(batch.column("doc_id"))
            for c in chunks(batch.column("text")):
                mine = ids[c.first : c.first + c.n]
                row, h = tokens(c)
                place, unit = v.look_up(h)
                add = np.zeros(len(h), np.float32)
                f = features(row, h)
                for a in range(0, len(h), 16384):
                    k = slice(a, a + 16384)
                    add[k] = w.log_prob(v, f[k], unit[k]) - v.log_unit[unit[k]]
                frequent = place >= 0
                n = np.bincount(row, minlength=c.n)
                known = np.bincount(row[frequent], minlength=c.n)
                part_sum = np.bincount(row[frequent], logs[place[frequent]], minlength=c.n)
                gain = np.bincount(row, add.astype(np.float64), minlength=c.n) / np.log(10)
                # A key per row content: rows alike in id and words share it, and are divided by their number at the end.
                key = mix(mine.view(np.uint64)) ^ (np.add.reduceat(mix(h + np.arange(len(h), dtype=np.uint64) - np.repeat(np.cumsum(n) - n, n).astype(np.uint64)), np.cumsum(n) - n) if len(h) else U(0))
                own.append((key, mine, n, known, part_sum, gain))
                rr, rh = row[~frequent], h[~frequent]
                order = np.argsort(rh)
                order = order[np.argsort(rr[order], kind="stable")]
                rr, rh = rr[order], rh[order]
                new = np.concatenate([[True], (rr[1:] != rr[:-1]) | (rh[1:] != rh[:-1])]) if len(rr) else np.zeros(0, bool)
                at = np.flatnonzero(new)
                far.append((rr[at] + rows, rh[at], np.diff(np.append(at, len(rr)))))
                rows += c.n
                size += len(at) + c.n
                if size > GATHER:
                    yield flush(own, far)
                    own, far, rows, size = [], [], 0, 0
        if own:
            yield flush(own, far)

    return run


def _look_up(shards: int):
    """In a shard: each text's sum over its words there, sent to the text's bucket (kind 3). Buckets' own rows pass."""

    def run(batches):
        h = n = None
        wait = []

        def answer(m):
            docs, k = (int(x) for x in np.frombuffer(m, "<i8", 2))
            key = np.frombuffer(m, "<u8", docs, 16)
            size = np.frombuffer(m, "<i4", docs, 16 + 8 * docs)
            word = np.frombuffer(m, "<u8", k, 16 + 12 * docs)
            times = np.frombuffer(m, "<i4", k, 16 + 12 * docs + 8 * k).astype(np.int64)
            if h is not None and len(h):
                at = np.minimum(np.searchsorted(h, word), len(h) - 1)
                count = np.where(h[at] == word, n[at], 0)
            else:
                count = np.zeros(k, np.int64)
            at = np.cumsum(size) - size
            return key, np.add.reduceat(times * (count > 0), at), np.add.reduceat(times * np.log10(count + 0.1), at)

        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            if (kinds == 2).any():
                yield batch.filter(pa.array(kinds == 2))
            for i in np.flatnonzero(kinds == 0):
                h, n = _read_counts(_unzip(batch.column("blob")[int(i)]))
            wait += [batch.column("blob")[int(i)] for i in np.flatnonzero(kinds == 1)]
        parts = {}
        for blob in wait:
            for name, x in zip("kns", answer(_unzip(blob)), strict=True):
                parts.setdefault(name, []).append(x)
        if not parts:
            return
        key, known, sums = (np.concatenate(parts[x]) for x in "kns")
        out, to = [], []
        for p, k in by_group((mix(key) % U(shards)).astype(np.int64)):
            to.append(p)
            out.append(_zip(np.array([len(k)], "<i8").tobytes(), key[k].tobytes(), known[k].astype("<i8").tobytes(), sums[k].tobytes()))
        yield _rows(to, 3, out)

    return run


def _finish(total: int, types: int):
    def run(batches):
        own, far = [], []
        for batch in batches:
            for kind, blob in zip(batch.column("kind").to_pylist(), batch.column("blob"), strict=True):
                m = _unzip(blob)
                k = int(np.frombuffer(m, "<i8", 1)[0])
                at = lambda i, t: np.frombuffer(m, t, k, 8 + 8 * k * i)  # noqa: B023, E731
                if kind == 2:
                    own.append((at(0, "<u8"), at(1, "<i8"), at(2, "<i8"), at(3, "<i8"), at(4, "<f8"), at(5, "<f8")))
                else:
                    far.append((at(0, "<u8"), at(1, "<i8"), at(2, "<f8")))
        if not own:
            return
        key, ids, n, known, base, gain = (np.concatenate(x) for x in zip(*own, strict=True))
        u, inv, times = np.unique(key, return_inverse=True, return_counts=True)
        if far:
            fk, fn, fs = (np.concatenate(x) for x in zip(*far, strict=True))
            # Sums in one order, whichever task answered first.
            order = np.lexsort((fs, fk))
            at = np.searchsorted(u, fk[order])
            known = known + (np.bincount(at, fn[order], minlength=len(u)) / times).round().astype(np.int64)[inv]
            base = base + (np.bincount(at, fs[order], minlength=len(u)) / times)[inv]
        base = base - n * np.log10(total + 0.1 * (types + 1))
        for a in range(0, len(ids), 10000):
            s = slice(a, a + 10000)
            yield pa.RecordBatch.from_arrays([pa.array(ids[s], mask=ids[s] == TOP), pa.array(n[s]), pa.array(known[s]), pa.array(base[s]), pa.array((base + gain)[s])], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return run


def score(docs: DataFrame, folds: int = 10, rounds: int = 3, rate: float = 0.15) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    sc, shards = spark.sparkContext, shuffle_width(spark)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = slim.where(F.col("doc_id").isNotNull() & ~held_out(folds))
    counts = texts.select("text").mapInArrow(_count(shards), BLOB).repartitionById(shards, F.col("part")).mapInArrow(_add_up, "part int, types long, tokens long, unit_types array<long>, unit_tokens array<long>, blob binary")
    counts = materialize(counts, "counts")
    every = [F.sum(F.col(x)[i]).alias(f"{x}{i}") for x in ("unit_types", "unit_tokens") for i in range(RARE)]
    s = counts.agg(F.coalesce(F.sum("types"), F.lit(0)).alias("types"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), *every).first()
    total, types = s["tokens"], s["types"]
    least = max(2, min(100, total // 8192))
    heavy = counts.select("blob").mapInArrow(_heavy(least), "h long, n long").orderBy(F.desc("n"), "h").limit(MOST_UNITS).toPandas()
    units = [np.array([s[f"{x}{i}"] or 0 for i in range(RARE)], float) for x in ("unit_types", "unit_tokens")]
    vocab = sc.broadcast(Vocabulary(heavy["h"].to_numpy("int64").view("uint64"), heavy["n"].to_numpy("int64"), types, total, *units))
    weights = sc.broadcast(train(texts, vocab, total, rounds, rate) if total else Weights(vocab.value.levels, 1))
    known = counts.select("part", F.lit(0).alias("kind"), "blob")
    asked = slim.mapInArrow(_measure(shards, vocab, weights), BLOB).unionByName(known).repartitionById(shards, F.col("part"))
    found = asked.mapInArrow(_look_up(shards), BLOB).repartitionById(shards, F.col("part")).mapInArrow(_finish(total, types), "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return found.select("doc_id", held_out(folds).alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
