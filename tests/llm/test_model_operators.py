"""Packing, pseudonyms, quality, language and neighbours: brute force, round trips and held-out accuracy."""

import bisect
import os
import pickle
import random
import re
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ridgecast.llm import language, nearest, packing, pseudonyms, quality, store

# Packing


def best_fit(lengths, size):
    """Best fit decreasing, one piece at a time, into bins of one size: the number of bins."""
    rooms, bins = [], 0
    for n in sorted(lengths, reverse=True):
        k = bisect.bisect_left(rooms, n)
        if k == len(rooms):
            bins += 1
            bisect.insort(rooms, size - n)
        else:
            room = rooms.pop(k)
            bisect.insort(rooms, room - n)
    return bins


def test_plan_on_counts_equals_best_fit_piece_by_piece():
    for seed in range(60):
        rnd = random.Random(seed)
        h = {rnd.randint(1, 64): rnd.randint(1, 30) for _ in range(rnd.randint(1, 30))}
        groups = packing.plan(h, (64,))
        assert sum(g.count for g in groups) == best_fit([n for n, c in h.items() for _ in range(c)], 64)


def best_fit_of_several(lengths, sizes, cost):
    """Best fit decreasing, piece by piece: [(size, pieces)] after downsizing.

    Where no open bin fits, the size is chosen whose price per token is least if it were filled from what is left, longest first; equal
    pieces go on to open bins of that size while they fill them.
    """
    left = sorted(lengths, reverse=True)
    bins, run = [], (None, None, 0)
    while left:
        n = left[0]
        fits = [b for b in bins if b[0] - sum(b[1]) >= n]
        if fits:
            min(fits, key=lambda b: b[0] - sum(b[1]))[1].append(left.pop(0))
            continue
        if run[0] != n or not run[2]:
            priced = []
            for size in sorted(s for s in sizes if s >= n):
                used = 0
                for m in left:
                    used += m if used + m <= size else 0
                priced.append((cost(size) / used, size))
            size = min(priced)[1]
            run = (n, size, max(1, left.count(n) // (size // n)))
        bins.append((run[1], [left.pop(0)]))
        run = (n, run[1], run[2] - 1)
    return [(min(s for s in sizes if s >= sum(p)), p) for _, p in bins]


def test_plan_equals_joint_best_fit_piece_by_piece():
    """As many bins, at the same cost but for bins with equal room, of which either may take a piece."""
    sizes, cost = (16, 32, 64), packing.default_cost
    dear = lambda s: s**1.2
    for seed in range(80):
        rnd = random.Random(seed)
        price = dear if seed % 2 else cost
        h = {rnd.randint(1, 64): rnd.randint(1, 12) for _ in range(rnd.randint(1, 12))}
        groups = packing.plan(h, sizes, price)
        want = best_fit_of_several([n for n, c in h.items() for _ in range(c)], sizes, price)
        assert sum(g.count for g in groups) == len(want), seed
        assert sum(price(g.size) * g.count for g in groups) == pytest.approx(sum(price(s) for s, _ in want), rel=0.1), seed


def test_plan_places_every_piece_once_and_downsizes():
    for seed in range(100):
        rnd = random.Random(seed)
        sizes = (16, 32, 64)
        h = {rnd.randint(1, 64): rnd.randint(1, 30) for _ in range(rnd.randint(1, 30))}
        groups = packing.plan(h, sizes)
        placed = {}
        for g in groups:
            used = sum(n * k for n, k in g.items)
            assert g.size == min(s for s in sizes if s >= used)
            for n, k in g.items:
                placed[n] = placed.get(n, 0) + k * g.count
        assert placed == h


def test_pack(docs, rows, empty):
    got = packing.pack(docs, sizes=(64, 128, 512)).toPandas()
    assert packing.pack(empty).count() == 0
    none = got[got.n_tokens == 0]
    assert none.bin_id.isna().all() and set(none.doc_id.dropna()) == {0, 1, 2}
    live = got[got.n_tokens > 0]
    for (_, size), g in live.groupby(["bin_id", "bin_size"]):
        g = g.sort_values("bin_offset")
        assert (g.bin_offset.to_numpy() == np.concatenate([[0], np.cumsum(g.n_tokens)[:-1]])).all()
        used = g.n_tokens.sum()
        assert size == min(s for s in (64, 128, 512) if s >= used)
    assert live.groupby("bin_id").bin_size.nunique().max() == 1
    long = live[live.doc_id == 14].sort_values("piece")
    assert long.n_tokens.sum() == 6001 and (long.n_tokens.iloc[:-1] == 512).all() and (long.start.to_numpy() == 512 * np.arange(len(long))).all()
    assert len(live[live.doc_id == 25]) == 2


# Pseudonyms

KEY = b"test key"
VALUES = [
    ("email", "nt.26@mail6.example.com"),
    ("phone", "+1 (136) 555-7479"),
    ("phone", "(613) 555-0000"),
    ("ip", "22.102.42.45"),
    ("card", "4845168114407329"),
    ("card", "4845 1681 1440 7329"),
    ("ssn", "123-45-6789"),
    ("iban", "GB82WEST12345698765432"),
    ("date", "2024-02-29"),
    ("date", "31.12.1999"),
    ("date", "31/12/1999"),
    ("date", "12/31/1999"),
]


@pytest.mark.parametrize(("kind", "value"), VALUES)
def test_pseudonyms_keep_the_format_and_come_back(kind, value):
    p = pseudonyms.pseudonym(kind, value, KEY)
    assert p != value and pseudonyms.pseudonym(kind, p, KEY, True) == value
    if kind in ("card", "phone", "ssn", "date"):
        assert [c.isdigit() for c in p] == [c.isdigit() for c in value]
    assert pseudonyms.pseudonym(kind, value, b"another") != p


FORMS = [
    ("phone", "555-123-4567"),
    ("phone", "555.123.4567"),
    ("phone", "555 123 4567"),
    ("phone", "+44 20 7946 0958"),
    ("phone", "+33 1 23 45 67 89"),
    ("phone", "+49 (0) 30 123456"),
    ("phone", "+372 5123"),
    ("iban", "DE89 3704 0044 0532 0130 00"),
    ("iban", "BE68 5390 0754 7034"),
    ("iban", "GB82 WEST 1234 5698 7654 32"),
    ("card", "3782 822463 10005"),
    ("card", "3782-822463-10005"),
    ("date", "1/2/2020"),
    ("date", "1/31/2020"),
    ("date", "31/1/2020"),
    ("date", "1.2.2020"),
    ("date", "2020/01/02"),
    ("date", "2020/1/2"),
]


@pytest.mark.parametrize(("kind", "value"), FORMS)
def test_every_written_form_is_found_in_text_and_comes_back(kind, value):
    shape = lambda s: ["0" if c.isdigit() else "A" if c.isalpha() else c for c in s]
    for text in (f"{value}", f"At 5: {value} THIS and 7", f"({value}), {value}."):
        new, counts = pseudonyms.rewrite(text, KEY)
        assert value not in new and counts == {kind: text.count(value)}
        assert shape(new) == shape(text)
        assert pseudonyms.rewrite(new, KEY, back=True)[0] == text


def test_forms_of_one_value_stay_linked():
    digits = lambda kind, s: re.sub("[^0-9A-Z]", "", pseudonyms.pseudonym(kind, s, KEY))
    for kind, a, b in (("phone", "+33 1 23 45 67 89", "+33123456789"), ("iban", "BE68 5390 0754 7034", "BE68539007547034"), ("card", "3782 822463 10005", "378282246310005")):
        assert digits(kind, a) == digits(kind, b)
    assert digits("phone", "+1 555 123 4567") == "1" + digits("phone", "555-123-4567")


def test_dates_of_one_width_are_permuted_among_themselves():
    days = [f"{d}/{m}/2020" for m in range(1, 10) for d in range(1, 10)]
    new = [pseudonyms.pseudonym("date", x, KEY) for x in days]
    assert len(set(new)) == len(days) and all(re.fullmatch(r"\d/\d/\d{4}", x) for x in new)
    assert [pseudonyms.pseudonym("date", x, KEY, True) for x in new] == days


@pytest.mark.parametrize(("kind", "value"), [("card", "9807915762804490"), ("ip", "300.1.1.1"), ("ssn", "000-12-3456"), ("date", "2023-02-30"), ("iban", "GB83WEST12345698765432")])
def test_invalid_values_stay(kind, value):
    assert pseudonyms.pseudonym(kind, value, KEY) is None
    assert pseudonyms.rewrite(f"x {value} y", KEY)[0] == f"x {value} y"


@pytest.mark.parametrize("size", [2, 3, 10, 97, 1000])
def test_permutation_is_a_bijection(size):
    out = [pseudonyms.permute(i, size, KEY, "t") for i in range(size)]
    assert sorted(out) == list(range(size))
    assert [pseudonyms.permute(v, size, KEY, "t", True) for v in out] == list(range(size))


@pytest.mark.parametrize("length", [1, 2, 53, 60, 80, 120, 511, 512, 513, 1000, 5000])
def test_long_values_are_mixed_whole_and_come_back(length):
    rnd = random.Random(length)
    s = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz0123456789.") for _ in range(length - 1)) + "q"
    p = pseudonyms.permute_string(s, KEY, "t")
    assert pseudonyms.permute_string(p, KEY, "t", True) == s and [c.isdigit() for c in p] == [c.isdigit() for c in s]
    if length >= 53:
        # One other character at the end moves letters everywhere, the first ones too.
        other = pseudonyms.permute_string(s[:-1] + "r", KEY, "t")
        for x, y in ((s, p), (p, other)):
            assert x[:20] != y[:20] and x[-20:] != y[-20:]
            assert sum(a == b for a, b in zip(x, y, strict=True) if a != ".") < 0.3 * length


def test_an_address_of_any_length_does_not_stop_the_query(spark):
    mails = ["x" * n + "@mail.example.com" for n in (80, 120, 1000, 20000)]
    df = spark.createDataFrame([(i, f"to {m} now") for i, m in enumerate(mails)], "doc_id long, text string")
    got = pseudonyms.pseudonymise(df, KEY).orderBy("doc_id").collect()
    assert all(r.n_email == 1 and "xxxxx" not in r.text for r in got)
    back = pseudonyms.pseudonymise(spark.createDataFrame(got), KEY, back=True).orderBy("doc_id").collect()
    assert [r.text for r in back] == [f"to {m} now" for m in mails]


@pytest.mark.parametrize("bits", [1, 7, 34, 64, 65, 300, 1100, 3000])
def test_permutation_equals_plain_version(bits):
    rnd = random.Random(bits)
    size = rnd.randrange(1 << (bits - 1), 1 << bits) + 1
    for x in [0, size - 1, *(rnd.randrange(size) for _ in range(5))]:
        assert pseudonyms.permute(x, size, KEY, "t") == brute.feistel(x, size, KEY, "t")


def test_rewriting_equals_plain_finder(spark, sf):
    """Every text of the table, and texts full of numbers in and out of form."""
    rnd = random.Random(3)
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    bits = [v for _, v in VALUES + FORMS] + ["12", "a", "+", "+1", ".", "-", "/", " ", "(", ")", "@", "x@y", "1.2.3.4.5", "DE", "4" * 20, "é"]
    texts += ["".join(rnd.choice(bits) + rnd.choice(["", " ", ", ", "-", "."]) for _ in range(12)) for _ in range(500)]
    for t in texts:
        want, at, counts = [], 0, {}
        for kind, a, b in brute.candidates(t):
            new = pseudonyms.RULES[kind](t[a:b], KEY, False)
            counts[kind] = counts.get(kind, 0) + (new is not None)
            want += [t[at:a], t[a:b] if new is None else new]
            at = b
        got, found = pseudonyms.rewrite(t, KEY)
        assert got == "".join(want) + t[at:], t
        assert found == {k: n for k, n in counts.items() if n}


def test_pseudonymise(spark, docs, rows, empty):
    text = "Mail a.b1@mail2.example.com or +1 (136) 555-7479, ip 22.102.42.45, card 4845168114407329; again 4845168114407329."
    extra = spark.createDataFrame([(500, text), (501, "card 4845168114407329")], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(extra)
    got = pseudonyms.pseudonymise(both, KEY)
    by = {r.doc_id: r for r in got.collect()}
    assert (by[500].n_email, by[500].n_phone, by[500].n_ip, by[500].n_card) == (1, 1, 1, 2)
    for secret in ("a.b1@", "136) 555", "22.102.42.45", "4845168114407329"):
        assert secret not in by[500].text
    assert by[501].text.split()[1] in by[500].text  # equal values stay linked
    assert by[0].text is None and by[1].text == ""
    back = {r.doc_id: r.text for r in pseudonyms.pseudonymise(got, KEY, back=True).collect()}
    assert back[500] == text and all(back[d] == t for d, t in rows if d is not None)
    assert pseudonyms.pseudonymise(docs, KEY).count() == len(rows)
    assert pseudonyms.pseudonymise(empty, KEY).count() == 0


# Quality


def fold(doc_id, folds=10):
    return zlib.crc32(str(doc_id).encode()) % folds


def test_quality_on_a_fold_that_nothing_saw(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    unseen = labels.where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(10)) == 0)
    got = quality.quality(docs, labels).join(unseen, "doc_id").groupBy("quality").agg(F.avg(F.col("keep").cast("int")).alias("k"))
    k = {r.quality: r.k for r in got.collect()}
    assert k[1] > 0.98 and k[0] < 0.25


def test_quality_edges(spark, docs, rows, empty):
    labels = spark.createDataFrame([(8, 1, 0), (8, 1, 0), (14, 1, None), (12, None, 0), (None, 1, 0), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.quality(docs, labels)
    assert got.count() == len(rows)
    blank = {r.doc_id: r for r in got.where("n_words = 0").collect()}
    assert set(blank) == {0, 1, 2, None} and all(r.keep and r.score is None for r in blank.values())
    none = quality.quality(docs, labels.limit(0))
    assert none.where("not keep or score is not null").count() == 0 and none.count() == len(rows)
    assert {r.doc_id: r.n_words for r in none.collect()}[14] == 6000
    assert quality.quality(empty, labels).count() == 0
    assert quality.keep_good(docs, labels.limit(0)).columns == docs.columns


@pytest.mark.parametrize("head", [0, 50, 1 << 17])
def test_costs_equal_a_plain_kneser_ney(spark, docs, rows, head, monkeypatch):
    """Long and short trusted texts, whatever is looked up on the spot or in one or more shards; of every row of the table."""
    monkeypatch.setattr(quality, "SHARD_LOG2", 10 if head else 18)
    trusted = {d: t for d, t in rows if d in (8, 9, 14, 17, 25) or (d or 0) > 120}
    ids = spark.createDataFrame([(d,) for d in trusted], "doc_id long")
    texts = docs.select("doc_id", quality.content_of().alias("content"), "lang", "text")
    model, table = quality.train(docs.dropDuplicates(["doc_id"]), ids, head)
    assert head or not len(model.head_key)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.nll) for r in quality.perplexities(texts, model, table).collect())
    plain = brute.kneser_ney(list(trusted.values()), [t for _, t in rows])
    want = sorted((d is None, d or 0, n, nll) for (d, _), (n, nll) in zip(rows, plain, strict=True))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=2e-6)


def test_all_trusted_documents_are_trained_on(spark):
    """More than any bound on a sample; what the driver and each task hold is bounded by words and bits instead."""
    labels = spark.range(9000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    _, ids = quality.trusted_ids(labels)
    assert {r.doc_id for r in ids.collect()} == {i for i in range(9000) if fold(i) >= 3}
    keys = [(k,) for k in range(5000)] + [(quality.INNER | k,) for k in range(5000)]
    table = spark.createDataFrame(keys, "key long").repartition(3)
    model = quality.Model(None, None, None, 0.0, None, None, quality.bit_table(table), 1)
    some = np.array([k for (k,) in keys] + [quality.LAST | k for k in range(5000)])
    assert model.has(some).all() and model.has(some + (1 << 30)).mean() < 0.05


def test_a_full_bit_table_changes_no_cost(spark, docs, rows, monkeypatch):
    ids = spark.createDataFrame([(d,) for d, _ in rows if d in (8, 9, 14, 17, 25) or (d or 0) > 120], "doc_id long")
    texts = docs.select("doc_id", quality.content_of().alias("content"), "lang", "text")
    found = []
    for log2 in (27, 6):
        monkeypatch.setattr(quality, "MOST_BITS_LOG2", log2)
        model, table = quality.train(docs.dropDuplicates(["doc_id"]), ids, 50)
        found.append(sorted((str(r.doc_id), r.content, r.n_words, r.nll) for r in quality.perplexities(texts, model, table).collect()))
    assert len(model.bits) == 1 and found[0] == found[1]


def test_rejected_rows_alone_go(spark, docs, rows):
    """Rows of one id, or none, with different texts are judged each on its own."""
    text = dict((d, t) for d, t in rows if d is not None)
    data = [(i, " ".join(text[14].split()[k * 9 : k * 9 + 30])) for k, i in enumerate(range(2000, 2600))]
    junk = "@@@! " * 200
    data += [(1, data[0][1]), (1, junk), (None, data[1][1]), (None, junk), (2, None)]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("lang", F.lit("en")).withColumn("content", F.lit(1))
    labels = df.where("doc_id >= 2000").select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    left = quality.keep_good(df, labels)
    assert left.columns == df.columns
    kept = left.collect()
    assert not any(r.text == junk for r in kept) and sum(r.doc_id is None for r in kept) == 1
    assert sorted(r.doc_id for r in kept if r.doc_id in (1, 2)) == [1, 2] and len(kept) > 0.97 * len(data)


# Language


def test_language_accuracy_and_edges(spark, docs, rows, empty):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    out = {r.doc_id: r for r in language.identify(docs).collect() if r.doc_id is not None}
    assert {d for d, r in out.items() if r.lang_pred == "und"} == {0, 1, 2, 16}
    assert all(0 <= r.score <= 1 for r in out.values())
    assert language.identify(docs).count() == len(rows)
    assert language.identify(empty).count() == 0
    alone = language.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert alone.where("lang_pred <> 'und' or score <> 0").count() == 0


def test_profile_distance_equals_plain_version(spark):
    from collections import Counter

    texts = {1: ("en", "the cat the dog the end of it"), 2: ("de", "der Hund und die Katze äöü"), 3: (None, "the hund")}
    grams = lambda t: Counter(g for w in _letters(t) for g in w)

    def _letters(t):
        s = language.SYMBOL[np.frombuffer(t.encode(), np.uint8)].tolist()
        p = [0, *s, 0]
        out = []
        for i in range(1, len(p) - 1):
            if p[i]:
                out.append([(3, p[i - 1], p[i], p[i + 1]), (2, p[i - 1], p[i]), (1, p[i])] + ([(2, p[i], 0)] if not p[i + 1] else []))
        return out

    code = {3: lambda a, b, c: (a * 155 + b) * 155 + c, 2: lambda a, b: 155**3 + a * 155 + b, 1: lambda a: 155**3 + 155**2 + a}
    rank = lambda t, size: {g: i for i, g in enumerate(sorted((code[k](*r) for k, *r in grams(t)), key=lambda g: (-{code[k](*r): n for (k, *r), n in grams(t).items()}[g], g))[:size])}
    df = spark.createDataFrame([(i, t, lang) for i, (lang, t) in texts.items()], "doc_id long, text string, lang string")
    learned = language.profiles(df, 20)
    for i in (1, 2):
        assert {r.gram: r["rank"] for r in learned.where(F.col("lang") == texts[i][0]).collect()} == rank(texts[i][1], 20)
    got = {r.doc_id: r for r in language.classify(df, learned, 20).collect()}
    mine = rank(texts[3][1], 20)
    dist = {texts[i][0]: sum(abs(p - rank(texts[i][1], 20)[g]) if g in rank(texts[i][1], 20) else 20 for g, p in mine.items()) for i in (1, 2)}
    assert got[3].lang_pred == min(dist, key=dist.get)
    assert got[3].score == pytest.approx(1 - min(dist.values()) / (len(mine) * 20))


# Neighbours


def truth(ids, x, every, k):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = (x @ x[i]) / (np.linalg.norm(x, axis=1) * np.linalg.norm(x[i]))
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), s[j]) for j in order]
    return out


def test_recall_and_scores(spark, sf):
    p = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = nearest.search(p, every=10).toPandas()
    t = p.toPandas()
    want = truth(t.vec_id.to_numpy(), np.stack(t.embedding.to_numpy()).astype(float), 10, 5)
    hit = 0
    for q, g in got.groupby("query_id"):
        g = g.sort_values("rank")
        assert g["rank"].tolist() == [1, 2, 3, 4, 5] and (np.diff(g.score) <= 0).all()
        s = dict(want[q])
        hit += len(set(g.vec_id) & set(s))
        for v, sc in zip(g.vec_id, g.score, strict=True):
            if v in s:
                assert sc == pytest.approx(s[v], abs=1e-12)
    assert hit / (5 * len(want)) >= 0.9


def test_neighbour_edges(spark):
    rows = [(0, [1.0, 0.0]), (50, [0.0, 2.0]), (1, [3.0, 0.0]), (2, [5.0, 0.0]), (3, None), (4, [0.0, 0.0]), (100, [0.0, float("nan")]), (150, [1.0, None]), (5, []), (6, [1.0, 1.0, 1.0]), (None, [1.0, 0.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, list int")
    got = {(r.query_id, r["rank"]): (r.vec_id, round(r.score, 6)) for r in nearest.search(df).collect()}
    assert got == {(0, 1): (1, 1.0), (0, 2): (2, 1.0), (0, 3): (7, 0.707107), (0, 4): (50, 0.0), (50, 1): (7, 0.707107), (50, 2): (0, 0.0), (50, 3): (1, 0.0), (50, 4): (2, 0.0)}
    assert nearest.search(df.limit(0)).count() == 0


def test_many_equal_vectors_are_dealt_in_blocks(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)] + [(1000 + i, [1.0] * 8) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest.search(df, every=50, block=64)
    t = df.toPandas()
    want = truth(t.vec_id.to_numpy(), np.stack(t.embedding.to_numpy()), 50, 5)
    hit = sum(r.vec_id in dict(want[r.query_id]) for r in got.collect())
    assert hit / (5 * len(want)) >= 0.9
    ones = [r.vec_id for r in got.where("query_id = 1050").orderBy("rank").collect()]
    assert ones == [1000, 1001, 1002, 1003, 1004]


def test_a_block_of_ties_answers_with_k_rows():
    rng = np.random.default_rng(1)
    q, ids = rng.normal(size=(512, 16)), rng.permutation(2048)
    got = nearest._best(np.arange(5000, 5512), q, ids, np.ones((2048, 16)), 5).to_pandas()
    assert len(got) == 5 * 512 and all(g.tolist() == [0, 1, 2, 3, 4] for _, g in got.groupby("query_id").vec_id)
    # An id with several vectors counts once, by its nearest.
    got = nearest._best(np.array([9]), np.array([[1.0, 0.0]]), np.array([1, 1, 2]), np.array([[1.0, 0.0], [1.0, 0.1], [0.0, 1.0]]), 2).to_pandas()
    assert got.vec_id.tolist() == [1, 2] and got.score.tolist() == [1.0, 0.0]


def test_very_large_and_very_small_components(spark):
    a, b = np.array([[1e300, 2e300, -1e299]]), np.array([[3e-310, 1e-310, 0.0]])
    assert np.isfinite(nearest.cosine(a, b)).all() and nearest.cosine(a, b)[0] == pytest.approx(nearest.cosine(a / 1e300, np.array([[3.0, 1.0, 0.0]]))[0], rel=1e-9)
    df = spark.createDataFrame([(0, [1e200, 0.0]), (1, [1e200, 1e200]), (2, [1e-200, 0.0])], "vec_id long, embedding array<double>")
    got = [(r.vec_id, round(r.score, 6)) for r in nearest.search(df).orderBy("rank").collect()]
    assert got == [(2, 1.0), (1, 0.707107)]


def test_a_vector_of_a_third_of_the_table_is_a_few_candidates(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist(), "v") for i in range(400)] + [(1000 + i, [1.0] * 8, "v") for i in range(300)] * 2
    kept, keep = {}, nearest.materialize
    monkeypatch.setattr(nearest, "materialize", lambda df, name: kept.setdefault(name, keep(df, name)))
    got = nearest.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>, e string")).collect()
    assert kept["candidates"].count() == 406
    ones = {q: [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in (1000, 1050)}
    assert ones == {1000: [1001, 1002, 1003, 1004, 1005], 1050: [1000, 1001, 1002, 1003, 1004]}


def test_shards_hold_their_ngrams_and_no_shuffle_files_or_tables_stay(spark, docs, rows):
    rng = np.random.default_rng(9)
    key = np.concatenate([rng.integers(0, quality.LAST, 500), quality.INNER | rng.integers(0, quality.PAIR, 300)])
    weight, after = rng.normal(size=(2, 800))
    after[:500] = 0.0
    table = pa.RecordBatch.from_arrays([pa.array(np.zeros(800, np.int32)), pa.array(key), pa.array(weight), pa.array(after)], names=["shard", "key", "weight", "next"])
    row = next(quality._pack([table.slice(0, 350), table.slice(350)]))
    got, want = quality.unpack(row.column("keys")[0], row.column("weights")[0]), quality.with_last(key, weight, after)
    assert all((a == b).all() for a, b in zip(got, want, strict=True))
    written, keep = [], quality.materialize
    with pytest.MonkeyPatch.context() as m:
        m.setattr(quality, "materialize", lambda df, name, *a: written.append((name, spark.conf.get(store.CLEANUP, None), keep(df, name, *a))) or written[-1][2])
        quality.quality(docs, spark.createDataFrame([(d, 1, 0) for d, _ in rows if d is not None], "doc_id long, quality int, toxic int"))
    assert spark.conf.get(store.CLEANUP, None) is None and {x[1] for x in written} == {"true"}
    left = {name for name, _, df in written if os.path.exists(df.stored_at.removeprefix("file://"))}
    assert "weights" in {x[0] for x in written} and left <= {"scores", "quantiles"}


def test_frequent_words_have_several_shards_and_costs_stay(spark, docs, rows, monkeypatch):
    """One word in every second place: its trigrams are dealt by the word before, its bigrams are whole in each shard, and what is sent is a trigram a word."""
    monkeypatch.setattr(quality, "SHARD_LOG2", 7)
    rng = np.random.default_rng(3)
    data = [(i, " ".join(x for k in rng.integers(0, 40, 60) for x in (f"w{k}", "the")), "en") for i in range(60)]
    data += [(100 + i, data[i][1] + " new words the w1", "en") for i in range(5)] + [data[59], (None, "the the w3", None), (200, None, "en")]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    ids = spark.createDataFrame([(i,) for i in range(50)], "doc_id long")
    model, table = quality.train(df, ids, 20)
    pieces = model.pieces(np.arange(len(model.known)))
    assert model.shards > 2 and pieces.max() > 1
    texts = df.select("doc_id", quality.content_of().alias("content"), "lang", "text").repartition(3)
    got = sorted((str(r.doc_id), r.n_words, r.nll) for r in quality.perplexities(texts, model, table).collect())
    plain = brute.kneser_ney([t for _, t, _ in data[:50]], [t for _, t, _ in data])
    want = sorted((str(d), n, nll) for (d, _, _), (n, nll) in zip(data, plain, strict=True))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=2e-6)
    again = pickle.loads(pickle.dumps(model))
    assert all((getattr(again, k) == getattr(model, k)).all() for k in quality.ARRAYS)


def test_shards_keep_counts_not_weights():
    """A trigram that occurs once takes a few bytes: before, 8 of its weight alone."""
    key = np.unique(np.random.default_rng(5).integers(0, 1 << 40, 50_000))
    row = next(quality._add_up([pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([quality._blob(np.diff(key, prepend=0))]), pa.array([quality._blob(np.ones(len(key), np.int64))])], names=["part", "keys", "counts"])]))
    found, n = quality.unpack(row.column("keys")[0], row.column("weights")[0])
    assert (found == key).all() and (n == 1).all()
    assert len(row.column("keys")[0].as_py()) + len(row.column("weights")[0].as_py()) < 6 * len(key)
