"""Language identification by rank-order profiles (Cavnar and Trenkle, 1994).

A text's letters (A-Z in lower case, and all non-ASCII bytes) give byte n-grams of one to three, words padded by a blank (the paper has one to
five; three tell the languages of the tables apart and keep the table of counts small). A language's
profile is its ``size`` most frequent n-grams over all its training texts; a document's profile is the same of its whole text. The distance to
a language is the sum over the document's n-grams of how far out of place they are, or ``size`` where the profile lacks
them. The least distance wins, the smaller label on ties. The score is 1 minus the mean distance over ``size``.

Training counts are combined in every task before they are exchanged; the alphabet bounds them (under 2**22 n-grams). The
profiles that are broadcast have ``size`` rows per label.

Nulls and edges: a null or empty text, or one without a letter, is ``und`` with score 0, and so is any text if nothing was
learned. A null language is not learned. A null doc_id takes no part in training and is not held out. Ties in frequency go by n-gram. Repeated
rows are returned one for one; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridgecast.llm.batches import U, chunks

SYMBOL = np.zeros(256, np.int32)
SYMBOL[97:123] = SYMBOL[65:91] = np.arange(1, 27)
SYMBOL[128:] = np.arange(27, 155)
BASE = 155
BITS = 22


def ngrams(c) -> np.ndarray:
    """Sorted keys (row << BITS | n-gram) of all n-grams of a chunk."""
    size = np.diff(c.bounds)
    s = np.zeros(len(c.data) + c.n + 2, np.int64)
    row = np.repeat(np.arange(c.n, dtype=np.int64), size)
    s[np.arange(len(c.data), dtype=np.int64) + row + 1] = SYMBOL[c.data]
    rows = np.zeros(len(s), np.uint64)
    rows[np.arange(len(c.data), dtype=np.int64) + row + 1] = row
    rows[:-1] = np.maximum(rows[:-1], 0)
    mid = np.flatnonzero(s)
    r = rows[mid] << U(BITS)
    left, here, right = s[mid - 1], s[mid], s[mid + 1]
    three = (left * BASE + here) * BASE + right
    two = BASE**3 + left * BASE + here
    last = right == 0
    ends = BASE**3 + here[last] * BASE
    one = BASE**3 + BASE**2 + here
    key = np.concatenate([r | three.astype(np.uint64), r | two.astype(np.uint64), r[last] | ends.astype(np.uint64), r | one.astype(np.uint64)])
    key.sort()
    return key


def _distinct(key: np.ndarray):
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[at], np.diff(np.append(at, len(key)))


GRAM_MASK = U((1 << BITS) - 1)


def _count_by_label(batches):
    total: dict[str, list] = {}
    for batch in batches:
        coded = pc.dictionary_encode(batch.column("lang"))
        labels, of = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
        for c in chunks(batch.column("text")):
            key, n = _distinct(ngrams(c))
            lab = of[c.first : c.first + c.n][(key >> U(BITS)).astype(np.int64)]
            g = (key & GRAM_MASK).astype(np.int64)
            for k in np.unique(lab):
                m = lab == k
                u, inv = np.unique(np.concatenate([g[m], *[x[0] for x in total.get(labels[k], [])]]), return_inverse=True)
                w = np.concatenate([n[m], *[x[1] for x in total.get(labels[k], [])]])
                total[labels[k]] = [(u, np.bincount(inv, w).astype(np.int64))]
    for label, [(g, n)] in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([label] * len(g), pa.string()), pa.array(g), pa.array(n)], names=["lang", "gram", "n"])


def profiles(docs: DataFrame, size: int = 400) -> DataFrame:
    """(lang, gram, rank) of the ``size`` most frequent n-grams per label of ``docs`` (text, lang)."""
    slim = docs.where("lang is not null and text is not null").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = slim.mapInArrow(_count_by_label, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")) - 1
    return counts.withColumn("rank", rank).where(F.col("rank") < size).select("lang", "gram", "rank")


def classify(docs: DataFrame, learned: DataFrame, size: int = 400) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, lang_pred, score."""
    rows = learned.toPandas()
    labels = sorted(rows["lang"].unique())
    grams = np.unique(rows["gram"].to_numpy("int64"))
    place = np.full((len(grams) + 1, len(labels)), -1, np.int32)
    place[np.searchsorted(grams, rows["gram"].to_numpy("int64")), [labels.index(x) for x in rows["lang"]]] = rows["rank"]
    shared = docs.sparkSession.sparkContext.broadcast((labels, grams, place))

    def run(batches):
        labels, grams, place = shared.value
        names = np.array([*labels, "und"], dtype=object)
        for batch in batches:
            for c in chunks(batch.column("text")):
                key, n = _distinct(ngrams(c))
                doc = key >> U(BITS)
                # Most frequent first within a row: one more sort, of (row, count from the top, n-gram).
                most = U((1 << 26) - 1)
                order = np.sort((doc << U(48)) | ((most - np.minimum(n.astype(np.uint64), most)) << U(BITS)) | (key & GRAM_MASK))
                doc = (order >> U(48)).astype(np.int64)
                rank = np.arange(len(doc)) - np.searchsorted(doc, doc, "left")
                top = rank < size
                doc, rank, g = doc[top], rank[top], (order[top] & GRAM_MASK).astype(np.int64)
                used = np.bincount(doc, minlength=c.n)
                best, pick = np.full(c.n, np.inf), np.full(c.n, len(labels))
                if len(grams):
                    at = np.minimum(np.searchsorted(grams, g), len(grams) - 1)
                    at = np.where(grams[at] == g, at, len(grams))
                    for k in range(len(labels)):
                        p = place[at, k]
                        d = np.bincount(doc, np.where(p < 0, size, np.abs(p - rank)), minlength=c.n)
                        better = d < best
                        best[better], pick[better] = d[better], k
                letters = np.zeros(c.n, bool)
                if len(c.data):
                    hit = (SYMBOL[c.data] > 0) & (c.data < 128)
                    run = np.concatenate([[0], np.cumsum(hit)])
                    letters = run[c.bounds[1:]] > run[c.bounds[:-1]]
                for i in np.flatnonzero(~letters & (used > 0)):
                    letters[i] = any(ch.isalpha() for ch in c.data[c.bounds[i] : c.bounds[i + 1]].tobytes().decode("utf-8", "replace"))
                ok = letters & np.isfinite(best)
                pick = np.where(ok, pick, len(labels))
                score = np.where(ok, np.clip(1 - np.where(ok, best, 0) / (np.maximum(used, 1) * size), 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(c.first, c.n), pa.array(names[pick], pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(folds: int):
    """True for rows outside training: the id's CRC-32 is divisible by ``folds``."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == 0, F.lit(False))


def identify(docs: DataFrame, folds: int = 5, size: int = 400) -> DataFrame:
    """Learn from the rows of ``docs`` that are not held out, classify all: doc_id, held_out, lang_pred, score."""
    learned = profiles(docs.where(F.col("doc_id").isNotNull() & ~held_out(folds)), size)
    return classify(docs, learned, size).select("doc_id", held_out(folds).alias("held_out"), "lang_pred", "score")
