"""Suffix-array dedup by bucket-pointer refinement.

Removes every byte covered by a ``span``-byte string (50) that also starts in a document with a smaller doc_id. Texts are
UTF-8 bytes, strings are judged on the input, and none crosses documents.

How it runs
1. Texts are dealt to buckets by id as compressed blobs; a task takes its buckets one after another. Every window of ``span`` bytes has an
   anchor: its 16-byte gram with the least hash, leftmost on ties. Equal windows have equal anchors. Consecutive windows with one anchor
   form a segment.
2. A task sends its buckets' distinct anchors' fingerprints and how often they occur to shards; a shard answers with two bits each: do two
   documents hold it, and does it occur ``HOT`` times or more? Text without shared anchors, most of it, takes no further part.
3. A task sends its buckets' distinct segments with a shared anchor, each with the smallest id that holds it. A hot anchor's segments are cut
   into their windows, which have shards of their own: a gram that a third of all documents have in varied surroundings is spread over all
   shards. The shard sorts suffixes: initial buckets by 8-byte grams, then refinement by the bucket pointers of the suffixes 8, 16 and 18
   bytes on, each round reusing the pointers that the last one updated, on suffixes in buckets of two or more only. After 50 bytes,
   suffixes in one bucket are equal windows. The answer has one bit per window: does a smaller id hold it?
4. A bucket removes a window from a document if its bit is set or the segment's smallest id is below the document's.

Only distinct segments of a bucket travel, so a passage in a third of all documents costs a shard one segment per
bucket; no group is collected. A task gathers what it sends over its buckets, so there are as many blobs as an exchange between tasks has
blocks, not as pairs of buckets. Memory is bounded by a bucket's or shard's share, whatever the number of partitions, and texts travel thrice.
Fingerprints of 40 bits only decide what is looked at; a window counts as equal by its bytes. Within a bucket, a segment is
told from another by 128 bits of hash.

Nulls and edges: a null text is empty. Texts under 50 bytes are never removed from. Rows that share a doc_id do not remove
from each other, so repeated rows stay. A null doc_id ranks as the largest id. Other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgecast.llm.batches import U, by_group, chunks, doc_ids, mix, pack40, ranges, span_hashes, unpack40
from ridgecast.llm.store import materialize, shuffle_width

GRAM = 16
BLOB = "part int, kind int, blob binary"
TOP = 2**63 - 1
#: An anchor that occurs so often is hot: its distinct segments may be more than a block of 2 MB.
HOT = 16384
#: Anchors, or bytes of segments, that a task gathers before it sends them.
GATHER_ANCHORS, GATHER_BYTES = 3_000_000, 32 << 20


def _squeeze(*parts: bytes) -> bytes:
    raw = b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _expand(blob) -> memoryview:
    m = memoryview(blob.as_buffer())
    return memoryview(pa.decompress(m[8:], int.from_bytes(m[:8], "little"), codec="zstd"))


def _rows(part, kind, blob) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([kind] * len(part), pa.int32()), pa.array(blob, pa.binary())], names=["part", "kind", "blob"])


def _texts(parts: int):
    """Documents dealt to buckets by id."""

    def run(batches):
        for batch in batches:
            ids = doc_ids(batch.column("doc_id"))
            for c in chunks(batch.column("text"), 32 << 20):
                own = ids[c.first : c.first + c.n]
                size = np.diff(c.bounds)
                part, blob = [], []
                for p, k in by_group((mix(own.view(np.uint64)) % U(parts)).astype(np.int64)):
                    text = b"".join(c.data[c.bounds[i] : c.bounds[i + 1]].tobytes() for i in k)
                    part.append(p)
                    blob.append(_squeeze(np.array([len(k)], "<i8").tobytes(), own[k].tobytes(), size[k].tobytes(), text))
                yield _rows(part, 0, blob)

    return run


def _by_part(batches):
    """(part, its texts' blobs, the shards' answers to it) for each bucket of a partition; blobs stay compressed until a bucket's turn."""
    texts: dict[int, list] = {}
    answers: dict[int, dict[int, dict]] = {}
    for batch in batches:
        for part, kind, blob in zip(batch.column("part").to_pylist(), batch.column("kind").to_pylist(), batch.column("blob"), strict=True):
            if kind == 0:
                texts.setdefault(part, []).append(blob)
                continue
            shard, to, count, m = _sections(_expand(blob))
            bits = np.frombuffer(m, np.uint8)
            size = (count + 7) // 8
            for k in range(1 if kind == 2 else 2):
                ends = np.cumsum(size) + k * size.sum()
                for p, n, e, z in zip(to.tolist(), count.tolist(), ends.tolist(), size.tolist(), strict=True):
                    answers.setdefault(p, {}).setdefault(kind + 2 * k, {})[shard] = (n, bits[e - z : e])
    for part in sorted(texts):
        yield part, texts.pop(part), answers.pop(part, {})


def _head(address: int, parts: np.ndarray, count: np.ndarray) -> bytes:
    return np.array([address, len(parts)], "<i8").tobytes() + parts.astype("<i8").tobytes() + count.astype("<i8").tobytes()


def _sections(m: memoryview):
    """(address, buckets, how many each has, the rest) of a blob that concerns several buckets."""
    address, n = (int(x) for x in np.frombuffer(m, "<i8", 2))
    return address, np.frombuffer(m, "<i8", n, 16), np.frombuffer(m, "<i8", n, 16 + 8 * n), m[16 + 16 * n :]


def _bits(flags: np.ndarray, count: np.ndarray) -> bytes:
    """Flags of consecutive sections, each from a byte of its own."""
    return b"".join(np.packbits(x).tobytes() for x in np.split(flags, np.cumsum(count)[:-1]))


class Bucket:
    """The texts of a bucket as one array, and the shards' answers about anchors (1: shared, 3: hot) and windows (2)."""

    def __init__(self, part, blobs, answers):
        ids, sizes, texts = [], [], []
        self.part, self.answers = part, answers
        for blob in blobs:
            m = _expand(blob)
            n = int(np.frombuffer(m, "<i8", 1)[0])
            ids.append(np.frombuffer(m, "<i8", n, 8))
            sizes.append(np.frombuffer(m, "<i8", n, 8 + 8 * n))
            texts.append(np.frombuffer(m, np.uint8, offset=8 + 16 * n))
        self.ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64) if ids else np.zeros(1, np.int64)
        self.data = np.concatenate(texts) if ids else np.zeros(0, np.uint8)

    def answered(self, kind: int, cut: np.ndarray) -> np.ndarray:
        """All answers of a kind; those of shard p belong from ``cut[p]`` on."""
        out = np.zeros(int(cut[-1]), bool)
        for p, (n, bits) in self.answers.get(kind, {}).items():
            out[cut[p] : cut[p] + n] = np.unpackbits(bits, count=n)
        return out

    def runs(self, span: int):
        """Segments of consecutive windows with one anchor: first and last window, document, anchor's hash."""
        out = []
        for lo, hi in _slices(self.bounds, 2 << 20):
            at = self.bounds[lo]
            a, b, h = anchor_runs(self.data[at : self.bounds[hi]], self.bounds[lo : hi + 1] - at, span)
            out.append((a + at, b + at, np.searchsorted(self.bounds, a + at, "right") - 1, h))
        if not out:
            z = np.zeros(0, np.int64)
            return z, z, z, z.astype(np.uint64)
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _slices(bounds, limit):
    a, n = 0, len(bounds) - 1
    while a < n:
        b = min(n, max(a + 1, int(np.searchsorted(bounds, bounds[a] + limit, "right")) - 1))
        yield a, b
        a = b


def _eights(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as one integer, most significant first; zeros follow the end."""
    n = len(data)
    padded = np.zeros(n + 16, np.uint8)
    padded[:n] = data
    v = np.empty(n, np.uint64)
    for k in range(8):
        m = len(v[k::8])
        v[k::8] = padded[k : k + 8 * m].view(">u8")
    return v


def anchor_runs(data: np.ndarray, bounds: np.ndarray, span: int):
    n = len(data)
    z = np.zeros(0, np.int64)
    if n < span:
        return z, z, z.astype(np.uint64)
    v = _eights(data)
    grams = n - GRAM + 1
    h = mix(v[:grams] * U(0xC2B2AE3D27D4EB4F) + v[8 : 8 + grams] * U(0x165667B19E3779F9))
    mask = U((1 << int(n).bit_length()) - 1)
    least = (h & ~mask) | np.arange(grams, dtype=np.uint64)
    width, have = span - GRAM + 1, 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[: len(least) - (width - have)], least[width - have :])
    anchor = (least & mask).astype(np.int64)
    size = np.diff(bounds)
    long = size >= span
    step = np.zeros(n + 1, np.int8)
    step[bounds[:-1][long]] += 1
    step[bounds[1:][long] - span + 1] -= 1
    valid = np.cumsum(step[: len(anchor)], dtype=np.int8).astype(bool)
    change = np.empty(len(anchor) + 1, bool)
    change[0] = change[-1] = True
    change[1:-1] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])
    edge = np.flatnonzero(change)
    a, b = edge[:-1], edge[1:] - 1
    ok = valid[a]
    a, b = a[ok], b[ok]
    # Anchors have the least hashes, which crowd at the low end; shards need them spread evenly.
    return a, b, mix(h[anchor[a]] + U(1))


def _shard_of(h: np.ndarray, parts: int) -> np.ndarray:
    """Shards in the order of hashes."""
    return (((h >> U(32)) * U(parts)) >> U(32)).astype(np.int64)


def _cuts(shard: np.ndarray, parts: int) -> np.ndarray:
    return np.searchsorted(shard, np.arange(parts + 1))


def _send_anchors(shards: int, span: int):
    def flush(kept):
        parts = np.array([k[0] for k in kept])
        u, multi, times = (np.concatenate([k[i] for k in kept]) for i in (1, 2, 3))
        owner = np.repeat(np.arange(len(kept)), [len(k[1]) for k in kept])
        shard = _shard_of(u, shards)
        order = np.argsort(shard, kind="stable")
        cut = _cuts(shard[order], shards)
        to, blobs = np.flatnonzero(np.diff(cut)), []
        for p in to:
            k = order[cut[p] : cut[p + 1]]
            section, n = np.unique(owner[k], return_counts=True)
            blobs.append(_squeeze(_head(parts[0], parts[section], n), pack40(u[k] & U((1 << 40) - 1)), times[k].astype("<u2").tobytes(), np.packbits(multi[k]).tobytes()))
        return _rows(to, 1, blobs)

    def run(batches):
        kept, have = [], 0
        for part, blobs, answers in _by_part(batches):
            b = Bucket(part, blobs, answers)
            _, _, doc, h = b.runs(span)
            kept.append((part, *_distinct_anchors(h, b.ids[doc])))
            have += len(kept[-1][1])
            if have > GATHER_ANCHORS:
                yield flush(kept)
                kept, have = [], 0
        if have:
            yield flush(kept)

    return run


def _distinct_anchors(h, ids):
    """Sorted anchors, whether two documents hold each, and how often it occurs (65,535 at most)."""
    order = np.argsort(h)
    hs, ds = h[order], ids[order]
    at = np.flatnonzero(np.concatenate([[True], hs[1:] != hs[:-1]])) if len(hs) else np.zeros(0, np.int64)
    if not len(at):
        return hs, np.zeros(0, bool), np.zeros(0, np.int64)
    return hs[at], np.minimum.reduceat(ds, at) != np.maximum.reduceat(ds, at), np.minimum(np.diff(np.append(at, len(hs))), 65535)


def _by_shard(batches):
    """(shard, its blobs) for each shard of a partition."""
    shards: dict[int, list] = {}
    for batch in batches:
        for part, blob in zip(batch.column("part").to_pylist(), batch.column("blob"), strict=True):
            shards.setdefault(part, []).append(blob)
    for shard in sorted(shards):
        yield shard, shards.pop(shard)


def _answer_anchors(hot: int):
    def run(batches):
        for own, rows in _by_shard(batches):
            sender, prints, multi, times = [], [], [], []
            for blob in rows:
                address, parts, count, m = _sections(_expand(blob))
                n = int(count.sum())
                sender.append((address, parts, count))
                prints.append(unpack40(m, n))
                times.append(np.frombuffer(m, "<u2", n, 5 * n))
                multi.append(np.unpackbits(np.frombuffer(m, np.uint8, offset=7 * n), count=n).astype(bool))
            x = np.concatenate(prints)
            order = np.argsort(x)
            xs = x[order]
            at = np.flatnonzero(np.concatenate([[True], xs[1:] != xs[:-1]]))
            size = np.diff(np.append(at, len(x)))
            shared, many = np.empty(len(x), bool), np.empty(len(x), bool)
            shared[order] = np.repeat(size > 1, size)
            shared |= np.concatenate(multi)
            many[order] = np.repeat(np.add.reduceat(np.concatenate(times).astype(np.int64)[order], at) >= hot, size)
            at, blobs = 0, []
            for _, parts, count in sender:
                k = slice(at, at + int(count.sum()))
                blobs.append(_squeeze(_head(own, parts, count), _bits(shared[k], count), _bits(many[k], count)))
                at = k.stop
            yield _rows([a for a, _, _ in sender], 1, blobs)

    return run


class Segments:
    """Distinct segments of a bucket whose anchor is shared, in an order that the texts alone fix."""

    def __init__(self, b: Bucket, shards: int, span: int):
        a, z, doc, h = b.runs(span)
        u, _, _ = _distinct_anchors(h, b.ids[doc])
        cut = _cuts(_shard_of(u, shards), shards)
        shared, hot = b.answered(1, cut), b.answered(3, cut)
        at = np.searchsorted(u, h)
        take = shared[at] if len(u) else np.zeros(0, bool)
        self.a, self.z, self.doc, h = a[take], z[take], doc[take], h[take]
        hot = hot[at][take] if len(u) else take
        if hot.any():
            # Windows of hot anchors are segments of their own, told apart by all their bytes.
            n = np.where(hot, self.z - self.a + 1, 1)
            first = ranges(self.a, n)
            self.z = np.where(np.repeat(hot, n), first, np.repeat(self.z, n))
            self.doc, h, hot = np.repeat(self.doc, n), np.repeat(h, n), np.repeat(hot, n)
            self.a = first
        f = np.empty(len(h), np.uint64)
        for lo, hi in _slices(b.bounds, 2 << 20):
            i, j = np.searchsorted(self.doc, [lo, hi])
            at = b.bounds[lo]
            f[i:j] = span_hashes(b.data[at : b.bounds[hi]], self.a[i:j] - at, self.z[i:j] + span - at)
        h = np.where(hot, mix(h ^ f), h)
        order = np.lexsort((f, h))
        hs, fs = h[order], f[order]
        new = np.concatenate([[True], (hs[1:] != hs[:-1]) | (fs[1:] != fs[:-1])]) if len(hs) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        self.of = np.empty(len(h), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.least = np.minimum.reduceat(b.ids[self.doc][order], at) if len(at) else np.zeros(0, np.int64)
        self.hash = hs[at]
        self.first = self.a[order[at]]
        self.windows = (self.z - self.a + 1)[order[at]]
        self.cut = _cuts(_shard_of(self.hash, shards), shards)


def _send_segments(shards: int, span: int):
    def flush(kept):
        for p in range(shards):
            mine = [(part, s, slice(s.cut[p], s.cut[p + 1]), text, ends) for part, s, text, ends in kept if s.cut[p + 1] > s.cut[p]]
            if not mine:
                continue
            get = lambda name, kind: b"".join(getattr(s, name)[k].astype(kind).tobytes() for _, s, k, _, _ in mine)  # noqa: B023, E731
            texts = b"".join(text[ends[k.start] : ends[k.stop]].tobytes() for _, _, k, text, ends in mine)
            head = _head(kept[0][0], np.array([part for part, *_ in mine]), np.array([k.stop - k.start for _, _, k, _, _ in mine]))
            yield _rows([p], 1, [_squeeze(head, get("hash", "<u8"), get("least", "<i8"), get("windows", "<i4"), texts)])

    def run(batches):
        kept, have = [], 0
        for part, blobs, answers in _by_part(batches):
            b = Bucket(part, blobs, answers)
            s = Segments(b, shards, span)
            size = s.windows + span - 1
            kept.append((part, s, b.data[ranges(s.first, size)], np.concatenate([[0], np.cumsum(size)])))
            # What only the bucket itself needs is not kept.
            s.a = s.z = s.doc = s.of = s.first = None
            have += len(kept[-1][2])
            if have > GATHER_BYTES:
                yield from flush(kept)
                kept, have = [], 0
        if have:
            yield from flush(kept)

    return run


def refine(data: np.ndarray, depth: int = 50) -> np.ndarray:
    """Bucket pointers of all suffixes of ``data`` by their first ``depth`` bytes (zeros follow the end).

    A pointer is the place of the bucket's first suffix in the sorted order. Equal pointers: equal prefixes.
    """
    n = len(data)
    v = _eights(data)
    order = np.argsort(v)
    vs = v[order]
    new = np.concatenate([[True], vs[1:] != vs[:-1]])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, n))
    pointer = np.empty(n, np.uint64)
    pointer[order] = np.repeat(at, size)
    active = order[np.repeat(size > 1, size)]
    sorted_to = 8
    while sorted_to < depth and len(active):
        step = min(sorted_to, depth - sorted_to)
        # The pointers of later suffixes sort this bucket's; past the end they count as 0.
        later = np.where(active + step < n, pointer[np.minimum(active + step, n - 1)] + U(1), U(0))
        key = (pointer[active] << U(32)) | later
        o = np.argsort(key)
        active, key = active[o], key[o]
        whole = key >> U(32)
        outer = np.flatnonzero(np.concatenate([[True], whole[1:] != whole[:-1]]))
        inner = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(inner, len(key)))
        begin = outer[np.searchsorted(outer, inner, "right") - 1]
        moved = whole[inner] + (inner - begin).astype(np.uint64)
        pointer[active] = np.repeat(moved, size)
        active = active[np.repeat(size > 1, size)]
        sorted_to += step
    return pointer


def _answer_segments(span: int):
    def shard(own, rows):
        sender, h, least, windows, text = [], [], [], [], []
        for blob in rows:
            address, parts, count, m = _sections(_expand(blob))
            n = int(count.sum())
            sender.append((address, parts, count))
            h.append(np.frombuffer(m, "<u8", n))
            least.append(np.frombuffer(m, "<i8", n, 8 * n))
            windows.append(np.frombuffer(m, "<i4", n, 16 * n))
            text.append(np.frombuffer(m, np.uint8, offset=20 * n))
        h, least, windows, text = np.concatenate(h), np.concatenate(least), np.concatenate(windows).astype(np.int64), np.concatenate(text)
        size = windows + span - 1
        start = np.concatenate([[0], np.cumsum(size)])[:-1]
        slot = np.concatenate([[0], np.cumsum(windows)])
        bits = np.zeros(int(slot[-1]), bool)
        order = np.argsort(h, kind="stable")
        hs = h[order]
        edges = np.flatnonzero(np.concatenate([[True], hs[1:] != hs[:-1], [True]]))
        filled = np.concatenate([[0], np.cumsum(size[order])])
        at = 0
        while at < len(edges) - 1:
            to = max(at + 1, int(np.searchsorted(filled[edges], filled[edges[at]] + (2 << 20), "right")) - 1)
            k = order[edges[at] : edges[to]]
            at = to
            # Equal segments of different buckets are sorted once.
            block = text[ranges(start[k], size[k])]
            ends = np.cumsum(size[k])
            f = span_hashes(block, ends - size[k], ends) ^ mix(h[k])
            u, first, inv = np.unique(f, return_index=True, return_inverse=True)
            low = np.full(len(u), TOP, np.int64)
            np.minimum.at(low, inv, least[k])
            uw = windows[k][first]
            ublock = block[ranges((ends - size[k])[first], size[k][first])]
            uend = np.cumsum(uw + span - 1)
            places = ranges(uend - (uw + span - 1), uw)
            rank = refine(ublock, span)[places]
            o = np.argsort(rank)
            new = np.concatenate([[True], rank[o][1:] != rank[o][:-1]])
            lowest = np.minimum.reduceat(np.repeat(low, uw)[o], np.flatnonzero(new))
            smallest = np.empty(len(rank), np.int64)
            smallest[o] = lowest[np.cumsum(new) - 1]
            uslot = np.concatenate([[0], np.cumsum(uw)])
            mine = smallest[ranges(uslot[inv], windows[k])]
            there = ranges(slot[k], windows[k])
            bits[there] = mine < np.repeat(least[k], windows[k])
        at, blobs = 0, []
        for _, parts, count in sender:
            ends = slot[at + np.concatenate([[0], np.cumsum(count)])]
            blobs.append(_squeeze(_head(own, parts, np.diff(ends)), _bits(bits[ends[0] : ends[-1]], np.diff(ends))))
            at += int(count.sum())
        return _rows([a for a, _, _ in sender], 2, blobs)

    def run(batches):
        for own, rows in _by_shard(batches):
            yield shard(own, rows)

    return run


OUT = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"


def _cut_texts(shards: int, span: int):
    def bucket(b):
        s = Segments(b, shards, span)
        slot = np.concatenate([[0], np.cumsum(s.windows)])
        bits = b.answered(2, slot[s.cut])
        n = s.z - s.a + 1
        gone = bits[ranges(slot[s.of], n)] | np.repeat(b.ids[s.doc] > s.least[s.of], n)
        place = ranges(s.a, n)[gone]
        doc = np.repeat(s.doc, n)[gone]
        new = np.concatenate([[True], (place[1:] > place[:-1] + span) | (doc[1:] != doc[:-1])]) if len(place) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        start = place[at]
        end = place[np.append(at[1:], len(place)) - 1] + span if len(at) else start
        owner = doc[at]
        per = np.searchsorted(owner, np.arange(len(b.ids) + 1))
        for lo, hi in _slices(b.bounds, 2 << 20):
            kept, spans = [], []
            for d in range(lo, hi):
                o, i, j = b.bounds[d], per[d], per[d + 1]
                if i == j:
                    kept.append(b.data[o : b.bounds[d + 1]].tobytes())
                else:
                    edge = np.concatenate([[o], np.stack([start[i:j], end[i:j]], 1).ravel(), [b.bounds[d + 1]]])
                    kept.append(b"".join(b.data[x:y].tobytes() for x, y in edge.reshape(-1, 2)))
            i, j = per[lo], per[hi]
            base = b.bounds[owner[i:j]]
            pairs = pa.StructArray.from_arrays([pa.array(start[i:j] - base), pa.array(end[i:j] - base)], names=["start", "end"])
            spans = pa.ListArray.from_arrays(pa.array((per[lo : hi + 1] - i).astype(np.int32)), pairs)
            ids = b.ids[lo:hi]
            yield pa.RecordBatch.from_arrays([pa.array(ids, mask=ids == TOP), pa.array(np.diff(b.bounds[lo : hi + 1])), spans, pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    def run(batches):
        for part, blobs, answers in _by_part(batches):
            yield from bucket(Bucket(part, blobs, answers))

    return run


def remove_repeats(docs: DataFrame, span: int = 50, part_bytes: int = 4 << 20, shard_bytes: int = 32 << 20, hot: int = HOT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, spans removed [start, end) in bytes, kept bytes.

    There are as many buckets as parts of ``part_bytes`` and as many shards as parts of ``shard_bytes``, and at least one per partition if
    texts suffice; a task takes its buckets or shards one after another.
    """
    assert GRAM < span <= 64
    width = shuffle_width(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = slim.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    spread = min(width, size >> 18)
    parts, shards = max(1, spread, -(-size // part_bytes)), max(1, spread, -(-size // shard_bytes))
    texts = slim.mapInArrow(_texts(parts), BLOB)

    def deal(df, of):
        return df.repartitionById(width, (F.col("part").cast("long") * width / of).cast("int"))

    anchors = deal(deal(texts, parts).mapInArrow(_send_anchors(shards, span), BLOB), shards).mapInArrow(_answer_anchors(hot), BLOB)
    anchors = materialize(anchors, "anchors")
    segments = deal(deal(texts.unionByName(anchors), parts).mapInArrow(_send_segments(shards, span), BLOB), shards).mapInArrow(_answer_segments(span), BLOB)
    return deal(texts.unionByName(anchors).unionByName(segments), parts).mapInArrow(_cut_texts(shards, span), OUT)


def digest(cut: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
