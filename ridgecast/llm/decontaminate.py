"""Benchmark decontamination by winnowing.

Words are runs of letters, digits and non-ASCII characters, with A-Z in lower case. A window is 10 consecutive words of an
item. Winnowing keeps, of each window, the five-word gram with the least hash, leftmost on ties: equal windows keep equal grams
at equal places, so every shared span of 10 words or more has a fingerprint that both sides keep. Training and test fingerprints
are joined on their hash; each meeting is verified on its words and extended word by word to both sides, five words at most, for
windows further on have fingerprints of their own. A span of 10 words or more that results is hit. Items of under 10 words are one
window of their own length; for each such length that occurs the whole window is the fingerprint.

Only SQL functions run on the data. Texts are never exchanged: a row leaves the scan with its word count and those of its
fingerprints that a table of the test side's lets pass. The table is a literal with 16 slots or more for each test fingerprint, which keeps all
but one in about 70 others back, up to 2**``most_log2`` slots (a byte each); a benchmark beyond a million fingerprints fills it more, which
makes more rows to join and no other result.

Nulls and edges: null and empty texts have no words; items without words have no window. Repeated items count once
(item_id); items without an id are ignored. There is a result row for every row of the documents, whatever its id: rows with one id, or none,
and different texts are judged each on its own, identical rows get the same result each. Empty tables give an empty
result or no hits; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgecast.llm.store import materialize

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
GRAM = 5
#: Grams in a window, and the most words to either side of a fingerprint within its window.
WIDTH = WINDOW - GRAM + 1
SIDE = WINDOW - GRAM
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PRINTS = "array<struct<at:int,len:int,fp:bigint,gram:array<string>,before:array<string>,after:array<string>>>"
#: Up to so many contaminated rows (40 bytes each) are broadcast; beyond that texts are joined by exchange.
BROADCAST_ROWS = 1_000_000


def item_words(text: str = "text") -> Column:
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    ascii_only = F.length(t) == F.octet_length(t)
    low = F.when(ascii_only, F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))
    return F.array_remove(F.split(low, SEPARATORS), "")


def _let(name: str, value: str, body: str) -> str:
    """``body`` with a lambda variable for ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _print(at: str, length: int, fp: str, words: str, before: str, after: str) -> str:
    return f"named_struct('at', {at}, 'len', {length}, 'fp', {fp}, 'gram', {words}, 'before', {before}, 'after', {after})"


def _winnowed(passes: str | None) -> str:
    """Fingerprints of the words ``w``: grams that are the least of a window, as far as ``passes`` (of x) lets them through."""
    first = f"greatest(1, p - {WIDTH - 1})"
    chosen = f"exists(sequence({first}, least(p, size(g) - {WIDTH - 1})), i -> array_position(slice(g, i, {WIDTH}), array_min(slice(g, i, {WIDTH}))) = p - i + 1)"
    keep = chosen if passes is None else f"{_let('x', 'element_at(g, p)', passes)} and {chosen}"
    side = f"reverse(slice(w, greatest(1, p - {SIDE}), least(p - 1, {SIDE})))"
    made = f"transform(filter(sequence(1, size(g)), p -> {keep}), p -> {_print('p - 1', WINDOW, 'element_at(g, p)', f'slice(w, p, {GRAM})', side, f'slice(w, p + {GRAM}, {SIDE})')})"
    made = _let("g", f"transform(sequence(1, size(w) - {GRAM - 1}), i -> xxhash64(slice(w, i, {GRAM})))", made)
    # The length is tested inside as well: Catalyst may infer a filter on the array and evaluate it first.
    return f"case when size(w) >= {WINDOW} then cast({made} as {PRINTS}) else cast(array() as {PRINTS}) end"


def _whole(m: int, passes: str) -> str:
    """Fingerprints that are whole windows of ``m`` words."""
    places = f"filter(sequence(1, size(w) - {m - 1}), i -> {_let('x', f'xxhash64(slice(w, i, {m}))', passes)})"
    none = "cast(array() as array<string>)"
    made = f"transform({places}, p -> {_print('p - 1', m, f'xxhash64(slice(w, p, {m}))', f'slice(w, p, {m})', none, none)})"
    return f"case when size(w) >= {m} then cast({made} as {PRINTS}) else cast(array() as {PRINTS}) end"


def test_prints(items: DataFrame) -> DataFrame:
    """Every distinct fingerprint of every item: item_id, len (the window's), fp, gram, before, after (words next to it, nearest first)."""
    w = items.select("item_id", item_words().alias("w")).where("item_id is not null and size(w) > 0")
    whole = _print("0", 0, "xxhash64(w)", "w", "cast(array() as array<string>)", "cast(array() as array<string>)").replace("'len', 0", "'len', size(w)")
    made = w.select("item_id", F.inline(F.expr(f"case when size(w) >= {WINDOW} then {_winnowed(None)} else cast(array({whole}) as {PRINTS}) end")))
    return made.select("item_id", "len", "fp", "gram", "before", "after").distinct()


def _slots(log2: int) -> tuple[str, str]:
    """The two slots of a fingerprint ``x``, from different bits."""
    n = (1 << log2) - 1
    return f"cast(x & {n} as int)", f"cast(shiftrightunsigned(x, {64 - log2}) & {n} as int)"


def _table(prints: DataFrame, log2: int) -> bytes:
    """A byte for each slot, 1 if a fingerprint has it; no more than 2**log2 places reach the driver."""
    both = prints.select(F.col("fp").alias("x")).select(F.explode(F.array(*(F.expr(k) for k in _slots(log2)))).alias("k")).distinct()
    table = bytearray(1 << log2)
    for batch in both.toArrow().to_batches():
        for k in batch.column(0).to_pylist():
            table[k] = 1
    return bytes(table)


def _common(a: str, b: str) -> str:
    """How many leading words of two arrays are equal."""
    n = f"least(size({a}), size({b}))"
    return f"case when {n} = 0 then 0 else size(filter(sequence(1, {n}), k -> slice({a}, 1, k) = slice({b}, 1, k))) end"


def decontaminate(docs: DataFrame, items: DataFrame, most_log2: int = 24) -> DataFrame:
    """Per row of ``docs``: doc_id, content (digest of its text), n_words, n_hit, n_items, items (ids), spans of hit words [start, end), contaminated."""
    prints = materialize(test_prints(items), "prints")
    lengths = {r["len"]: r["n"] for r in prints.groupBy("len").agg(F.count("*").alias("n")).collect()}
    log2 = min(most_log2, max(12, math.ceil(math.log2(16 * max(1, sum(lengths.values()))))))
    passes = " and ".join(f"substring(bits, {k} + 1, 1) = X'01'" for k in _slots(log2))
    made = f"concat({', '.join([_winnowed(passes), *(_whole(m, passes) for m in sorted(lengths) if m < WINDOW)])})"
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.unhex(F.md5(text)).alias("content"), item_words().alias("w"), F.lit(_table(prints, log2)).alias("bits"))
    rows = materialize(rows.select("doc_id", "content", F.size("w").cast("long").alias("n_words"), F.expr(made).alias("prints")), "scanned")

    mine = rows.where(F.size("prints") > 0).select("doc_id", "content", F.inline("prints"))
    other = prints.select("item_id", F.col("len").alias("len2"), F.col("fp").alias("fp2"), F.col("gram").alias("gram2"), F.col("before").alias("before2"), F.col("after").alias("after2"))
    met = mine.join(other, (mine["fp"] == other["fp2"]) & (mine["len"] == other["len2"]) & (mine["gram"] == other["gram2"]))
    met = met.withColumn("l", F.expr(_common("before", "before2"))).withColumn("r", F.expr(_common("after", "after2")))
    met = met.where(f"len < {WINDOW} or l + r + {GRAM} >= {WINDOW}").select("doc_id", "content", "item_id", (F.col("at") - F.col("l")).alias("start"), (F.col("at") + F.size("gram") + F.col("r")).alias("end"))
    hits = met.groupBy("doc_id", "content").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"), F.collect_set("item_id").alias("items"))

    each = rows.groupBy("doc_id", "content", "n_words").agg(F.count("*").alias("times"))
    hits = hits.withColumnsRenamed({"doc_id": "hit_id", "content": "hit_content"})
    found = each.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("content") == F.col("hit_content")), "left")
    kind = dict(hits.dtypes)
    found = found.withColumns({c: F.coalesce(c, F.array().cast(kind[c])) for c in ("spans", "items")})
    covered = F.expr("aggregate(spans, named_struct('to', 0, 'n', 0L), (a, x) -> named_struct('to', greatest(a.to, x.end), 'n', a.n + greatest(0, x.end - greatest(x.start, a.to))), a -> a.n)")
    found = found.select("doc_id", "content", "n_words", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items", "spans", (F.size("items") > 0).alias("contaminated"), "times")
    return found.withColumn("copy", F.explode(F.expr("sequence(1, times)"))).drop("copy", "times")


def digest(found: DataFrame) -> DataFrame:
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(ids, 256).alias("items_sha256"), "contaminated")


def remove_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any hit, each judged by its own text, whatever its id."""
    bad = materialize(decontaminate(docs, items).where("contaminated").select(F.col("content").alias("__content")).distinct(), "contaminated")
    if bad.count() <= BROADCAST_ROWS:
        bad = F.broadcast(bad)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumn("__content", F.unhex(F.md5(text))).join(bad, "__content", "left_anti").select(docs.columns)
