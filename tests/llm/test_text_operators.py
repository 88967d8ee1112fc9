"""Operators on texts against brute force; nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import random

import brute
import pytest
from pyspark.sql import functions as F

from ridgecast.llm import decontaminate, maxent, ngram_join, secrets, suffix_dedup

SHA = lambda s: hashlib.sha256(s.encode()).hexdigest()


def known(rows):
    return [(d, t) for d, t in rows if d is not None]


# N-gram Jaccard join


def test_jaccard_components(docs, rows):
    got = ngram_join.jaccard_components(docs).collect()
    want = brute.jaccard(known(rows))
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r
    assert sum(r.doc_id is None for r in got) == 2
    # The row without an id that repeats the text of 15 belongs to its component.
    assert {r.component_id for r in got if r.doc_id is None} == {15, None}


def test_jaccard_of_many_near_copies_and_chains(spark):
    rnd = random.Random(5)
    base = [f"t{rnd.randrange(5000)}" for _ in range(200)]
    rows, chain = [], list(base)
    for i in range(30):  # neighbours link, ends of the chain do not
        for _ in range(3):
            chain[rnd.randrange(200)] = f"n{i}{rnd.randrange(10**6)}"
        rows.append((1000 - i, " ".join(chain)))
    rows += [(2000 + i, " ".join(base[:20] + [f"u{i}{j}" for j in range(i % 9)])) for i in range(60)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.jaccard(rows)


def test_an_outsider_among_many_near_copies_makes_no_pairs_of_copies(spark, monkeypatch):
    """Open lists: copies share rare prefix tokens with a document of another component."""
    rnd = random.Random(6)
    base = [f"t{i}" for i in range(100)]
    rows = [(i, " ".join(base[:97] + [f"u{i}", f"v{i}", f"w{i}"])) for i in range(300)]
    # Outsiders share a part of the copies only: too little to link.
    rows += [(1000 + i, " ".join(base[i * 7 : i * 7 + 60] + [f"o{i}{j}" for j in range(20)])) for i in range(5)]
    rows += [(2000 + i, " ".join(base[:88] + [f"p{i}{rnd.random()}" for _ in range(6)])) for i in range(5)]
    counts, linked = [], ngram_join._linked

    def counted(pairs, *rest):
        counts.append(pairs.count())
        return linked(pairs, *rest)

    monkeypatch.setattr(ngram_join, "_linked", counted)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.jaccard(rows)
    assert sum(counts) < 20 * len(rows)


def test_classes_that_share_half_a_fingerprint_are_told_apart(docs, rows, monkeypatch):
    """The first salt makes all first halves alike."""
    salts, fingerprints = [], ngram_join.fingerprints

    def poor(row, token, size, salt=0):
        a, b = fingerprints(row, token, size, salt)
        return (a % 3 if salt == 0 else a), b

    monkeypatch.setattr(ngram_join, "fingerprints", poor)
    monkeypatch.setattr(ngram_join, "_profile", lambda width, salt, f=ngram_join._profile: salts.append(salt) or f(width, salt))
    got = ngram_join.jaccard_components(docs).collect()
    want = brute.jaccard(known(rows))
    assert salts == [0, 1]
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] for r in got if r.doc_id is not None)


def test_jaccard_empty(empty):
    assert ngram_join.jaccard_components(empty).count() == 0
    assert ngram_join.keep_one_per_component(empty).columns == empty.columns


def test_keep_one(docs, rows):
    kept = ngram_join.keep_one_per_component(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.where("doc_id is not null").collect())
    assert ids == sorted(d for d, (_, c) in brute.jaccard(known(rows)).items() if c == d)


# Decontamination


@pytest.fixture(scope="module")
def items(spark, rows):
    text = dict(known(rows))
    long = text[14].split()
    data = [(1, " ".join(long[100:115])), (2, " ".join(long[105:130]).upper()), (3, "two three"), (3, "two three"), (4, None), (5, "?!"), (6, text[15]), (7, "never anywhere seen " * 5), (None, "one"), (10, "one two three four five six seven eight nine ten")]
    return data, spark.createDataFrame(data, "item_id long, text string")


def test_decontamination(docs, rows, items):
    got = decontaminate.digest(decontaminate.decontaminate(docs, items[1])).collect()
    want = brute.decontaminate(known(rows), [(i, t) for i, t in items[0] if i is not None])
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == want[r.doc_id], r
    assert want[14][4] and want[15][4] and want[5][4] and not want[8][4]


def test_decontamination_empty(docs, empty, items):
    assert decontaminate.decontaminate(empty, items[1]).count() == 0
    assert decontaminate.decontaminate(docs, items[1].limit(0)).where("contaminated").count() == 0


def test_decontamination_with_a_full_table(docs, rows, items, monkeypatch):
    """However full the table, the result is the same."""
    monkeypatch.setattr(decontaminate, "_table", lambda prints, log2: bytes([1]) * (1 << log2))
    got = decontaminate.digest(decontaminate.decontaminate(docs, items[1])).collect()
    want = brute.decontaminate(known(rows), [(i, t) for i, t in items[0] if i is not None])
    assert all((r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == want[r.doc_id] for r in got if r.doc_id is not None)


def test_decontamination_of_rows_that_share_an_id_or_have_none(spark, items):
    dirty, clean = "one two three four five six seven eight nine ten", "one and only nine words with no hit at all"
    rows = [(1, dirty), (1, clean), (None, dirty), (None, clean), (None, clean), (2, dirty), (2, dirty)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_words, r.contaminated) for r in decontaminate.decontaminate(df, items[1]).collect())
    assert got == [(0, 10, False), (0, 10, False), (0, 10, True), (1, 10, False), (1, 10, True), (2, 10, True), (2, 10, True)]
    left = sorted((r.doc_id or 0, r.text) for r in decontaminate.remove_contaminated(df, items[1]).collect())
    assert left == [(0, clean), (0, clean), (1, clean)]


def test_decontamination_of_random_words_equals_brute_force(spark):
    """A small vocabulary makes ties, overlaps and items of every length."""
    rnd = random.Random(8)
    say = lambda n: " ".join(rnd.choice("abc") for _ in range(n))
    for vocabulary_rounds in range(2):
        test = [(i, say(rnd.choice([10, 11, 12, 15, 30]))) for i in range(25)] + ([(100 + m, say(m)) for m in (7, 8, 9)] if vocabulary_rounds else [])
        data = [(i, say(rnd.choice([3, 9, 10, 40, 300]))) for i in range(60)]
        data += [(1000 + i, f"{say(8)} {test[i][1]} {say(9)}") for i in range(20)]
        got = decontaminate.digest(decontaminate.decontaminate(spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(test, "item_id long, text string"))).collect()
        want = brute.decontaminate(data, test)
        assert {r.doc_id: tuple(r)[1:] for r in got} == want


def test_the_table_grows_with_the_benchmark(spark):
    """A million words of benchmark let no burst of fingerprints of other texts through."""
    items = spark.range(2000).select(F.col("id").alias("item_id"), F.expr("array_join(transform(sequence(1, 500), k -> concat('w', hash(id, k))), ' ')").alias("text"))
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.expr("array_join(transform(sequence(1, 500), k -> concat('v', hash(id, k))), ' ')").alias("text"))
    kept, keep = [], decontaminate.materialize
    try:
        decontaminate.materialize = lambda df, name: kept.append((name, keep(df, name))) or kept[-1][1]
        assert decontaminate.decontaminate(docs, items).where("contaminated").count() == 0
    finally:
        decontaminate.materialize = keep
    made = dict(kept)["scanned"].agg(F.sum(F.size("prints"))).first()[0]
    assert made < 0.02 * 300 * 500


def test_remove_contaminated(docs, rows, items):
    left = decontaminate.remove_contaminated(docs, items[1])
    assert left.columns == docs.columns
    want = brute.decontaminate([(i, t) for i, (_, t) in enumerate(rows)], [(i, t) for i, t in items[0] if i is not None])
    clean = sorted(str(rows[i]) for i, w in want.items() if not w[4])
    assert sorted(str((r.doc_id, r.text)) for r in left.collect()) == clean


# Secrets


def test_secrets(docs, rows):
    got = secrets.digest(secrets.findings(docs, secrets.scan(docs))).collect()
    assert len(got) == len(rows)
    text = dict(known(rows))
    for r in got:
        if r.doc_id is not None:
            *n, base = brute.secrets(text[r.doc_id])
            assert [r.n_assign, r.n_access, r.n_hex, r.base_sha256] == [*n, SHA(base)], r
    assert "pem:" in next(r.spans for r in got if r.doc_id == 24)


def test_ledger_scans_only_what_is_new(spark):
    v1 = spark.createDataFrame([("a", "token=aaaaaaaaaa"), ("b", "nothing")], "doc_id string, text string")
    book = secrets.scan(v1)
    # A blob that is marked as scanned is not looked at again: its (false) entry stays.
    marked = book.withColumn("spans", F.expr(f"cast(array() as {secrets.SPANS})"))
    v2 = v1.unionByName(spark.createDataFrame([("c", "token=bbbbbbbbbb"), ("d", "nothing")], "doc_id string, text string"))
    new = secrets.scan(v2, marked)
    assert new.count() == 3
    got = {r.doc_id: len(r.spans) for r in secrets.findings(v2, new).collect()}
    assert got == {"a": 0, "b": 0, "c": 1, "d": 0}
    # A raised version is scanned anew, and only that rule.
    import dataclasses

    raised = tuple(dataclasses.replace(r, version=2) if r.kind == "assign" else r for r in secrets.RULES)
    again = secrets.scan(v2, new, raised)
    assert {r.doc_id: len(r.spans) for r in secrets.findings(v2, again).collect()} == {"a": 1, "b": 0, "c": 1, "d": 0}


def test_a_ledger_that_stays(spark, tmp_path):
    """Three runs at one path: the second scans what is new, a failed one changes nothing, the third reads the second's."""
    df = lambda *rows: spark.createDataFrame(rows, "doc_id string, text string")
    book = secrets.Ledger(spark, f"file://{tmp_path}/ledger")
    assert book.read() is None
    first = book.update(df(("a", "token=aaaaaaaaaa"), ("b", "nothing")))
    assert first.count() == 2 and book.versions() == [0]
    new = df(("a", "token=aaaaaaaaaa"), ("c", "token=cccccccccc"))
    assert {r.doc_id: r.n_unseen for r in secrets.unseen(new, first).collect()} == {"a": 0, "c": len(secrets.RULES)}
    (tmp_path / "ledger" / "v7").mkdir()  # a version that was not completed
    second = secrets.Ledger(spark, f"file://{tmp_path}/ledger").update(new)
    assert book.versions() == [0, 1] and second.count() == 3
    assert {r.doc_id: len(r.spans) for r in secrets.findings(new, book.read()).collect()} == {"a": 1, "c": 1}
    book.update(df(("d", None)))
    assert book.versions() == [1, 2] and book.read().count() == 4


def test_a_text_of_very_many_matches(spark):
    text = "é " + "token=aaaaaaaa" * 30 + " " + "secret: bbbbbbbbb, " * 40000 + "0123456789abcdef" * 2
    (got,) = secrets.digest(secrets.findings(df := spark.createDataFrame([(1, text)], "doc_id long, text string"), secrets.scan(df))).collect()
    *n, base = brute.secrets(text)
    assert [got.n_assign, got.n_access, got.n_hex, got.base_sha256] == [*n, SHA(base)] and n[0] > 40000


def test_redaction(docs, rows, empty):
    out = secrets.redact(docs)
    assert out.columns == docs.columns and secrets.redact(empty).count() == 0
    got = {r.doc_id: r.text for r in out.collect() if r.doc_id is not None}
    assert got[22] == '[SECRET]" token: abc [SECRET]'
    text = dict(known(rows))
    assert all(got[d] == text[d] for d in (0, 1, 8, 14, 17))
    assert secrets.scan(out).where(F.size("spans") > 0).count() == 0


def test_secrets_empty(empty):
    assert secrets.scan(empty).count() == 0 and secrets.findings(empty, secrets.scan(empty)).count() == 0


# Suffix-array dedup


def test_repeats(docs, rows):
    got = suffix_dedup.digest(suffix_dedup.remove_repeats(docs)).collect()
    want = brute.repeats(list(dict(known(rows)).items()))
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r


@pytest.mark.parametrize(("part_bytes", "shard_bytes", "hot"), [(3000, 3000, 1 << 30), (3000, 20000, 3), (100000, 1000, 0)])
def test_repeats_in_many_parts(docs, rows, part_bytes, shard_bytes, hot, monkeypatch):
    """Many buckets and shards, several sendings of a task, and none, many or all anchors hot."""
    monkeypatch.setattr(suffix_dedup, "GATHER_ANCHORS", 50)
    monkeypatch.setattr(suffix_dedup, "GATHER_BYTES", 5000)
    got = suffix_dedup.digest(suffix_dedup.remove_repeats(docs, part_bytes=part_bytes, shard_bytes=shard_bytes, hot=hot)).collect()
    want = brute.repeats(list(dict(known(rows)).items()))
    assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id] for r in got if r.doc_id is not None)


def test_a_common_gram_in_varied_surroundings(spark):
    """Two thirds of the documents hold one line of 40 bytes; some repeat its neighbourhood too."""
    rnd = random.Random(9)
    line = "x" * 4 + "common boilerplate line of forty by" + "x"
    around = lambda: "".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(0, 30)))
    rows = [(i, around() + (line if i % 3 else "") + around()) for i in range(900)]
    rows += [(2000 + i, rows[i * 7][1] + around()) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = brute.repeats(rows)
    for hot in (1 << 30, 100):
        got = suffix_dedup.digest(suffix_dedup.remove_repeats(df, part_bytes=4000, hot=hot)).collect()
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want


def test_repeats_empty(empty):
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_refinement_is_a_suffix_array_to_its_depth():
    import numpy as np

    rnd = np.random.default_rng(1)
    for alphabet in (1, 2, 4):
        b = rnd.integers(97, 97 + alphabet, 400).astype(np.uint8)
        p = suffix_dedup.refine(b, 50)
        prefix = [(b.tobytes() + b"\0" * 64)[i : i + 50] for i in range(len(b))]
        order = sorted(prefix)
        for i, x in enumerate(prefix):
            if i + 50 <= len(b):  # windows, which the operator compares
                assert order[int(p[i])] == x or prefix.count(x) == 1


# Language-model scores


def test_base_scores(docs, rows):
    got = maxent.score(docs).collect()
    # Both copies of the repeated row are learned, each as a text.
    n, want = brute.base_scores(known(rows))
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (*want[r.doc_id][:3], n), r
            assert r.base_score == pytest.approx(want[r.doc_id][3], rel=1e-9, abs=1e-9)
            assert r.score <= 0


def test_scores_of_an_empty_table(empty):
    assert maxent.score(empty).count() == 0


def test_nothing_to_learn_from(spark):
    import zlib

    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    got = maxent.score(spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 and r.held_out for r in got)


def test_model_beats_its_base_on_held_out_text(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    r = maxent.score(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


@pytest.fixture
def trained(monkeypatch):
    """What ``train`` was given and has made, as the scores are computed."""
    made, train = [], maxent.train
    monkeypatch.setattr(maxent, "train", lambda texts, vocab, *a: made.append((vocab.value, train(texts, vocab, *a))) or made[-1][1])
    return made


def test_every_training_text_changes_the_weights(spark, trained):
    import zlib

    import numpy as np
    import pyarrow as pa

    from ridgecast.llm.batches import chunks

    texts = [(i, f"left{i} right{i}") for i in range(200) if zlib.crc32(str(i).encode()) % 10]
    maxent.score(spark.createDataFrame(texts, "doc_id long, text string")).count()
    for i, text in texts:
        (c,) = chunks(pa.array([text]))
        f = maxent.features(*maxent.tokens(c))
        rows = trained[0][1].index(f, 0, np.zeros(len(f), np.int64))
        # The context of the text's end is its own two words, which occur in no other text.
        assert trained[0][1].tables[0][rows[2, 1]].any(), i


def test_scores_do_not_depend_on_partitions(spark, sf, monkeypatch):
    """Several groups and rounds; the table in 1, 3 and 8 partitions."""
    monkeypatch.setattr(maxent, "GROUP_TOKENS", 5000)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = [{r.doc_id: r.score for r in maxent.score(docs.repartition(n)).collect()} for n in (1, 3, 8)]
    for other in got[1:]:
        assert other.keys() == got[0].keys()
        assert all(other[d] == pytest.approx(got[0][d], rel=1e-9, abs=1e-6) for d in other)


def test_scores_equal_a_plain_version(spark, docs, rows, trained):
    """Every text's score from the trained weights, token by token in plain Python."""
    import math

    import numpy as np

    got = {r.doc_id: r.score for r in maxent.score(docs).collect() if r.doc_id is not None}
    v, w = trained[0]
    base = brute.base_scores(known(rows))[1]
    assert v.levels == 2 and len(v.h) > 0
    for d, text in dict(known(rows)).items():
        if len(text or "") > 2000:
            continue
        import pyarrow as pa

        from ridgecast.llm.batches import chunks

        hashes = [int(x) for c in chunks(pa.array([text or ""])) for x in maxent.tokens(c)[1]]
        gain, before = 0.0, [maxent.BEGIN, maxent.BEGIN]
        for h in hashes:
            two, one = before
            f = [maxent.mix(x) for x in (np.array([one * maxent.STEP[10]]), np.array([one * maxent.STEP[11] + two * maxent.STEP[12]]), np.array([two * maxent.STEP[13]]))]
            where = np.flatnonzero(v.h == np.uint64(h))
            unit = int(v.unit[where[0]]) if len(where) else v.first_rare + h % maxent.RARE
            log_p, mass = 0.0, np.exp(v.log_unit.astype(float))
            for level in range(v.levels):
                width = maxent.BRANCHES ** (v.levels - level)
                node, branch = unit // width, unit % width // (width // maxent.BRANCHES)
                logits = []
                for k in range(maxent.BRANCHES):
                    lo = node * width + k * (width // maxent.BRANCHES)
                    m = mass[lo : lo + width // maxent.BRANCHES].sum() / mass[node * width : (node + 1) * width].sum()
                    x = sum(float(w.tables[level][int(maxent.mix(y + np.uint64(node) * maxent.STEP[20] + maxent.STEP[21 + level])[0]) % (1 << w.log2)][k]) for y in f)
                    logits.append(math.log(m) + x if m > 0 else -math.inf)
                top = max(logits)
                log_p += logits[branch] - top - math.log(sum(math.exp(x - top) for x in logits))
            gain += (log_p - float(v.log_unit[unit])) / math.log(10)
            before = [one, np.uint64(h)]
        assert got[d] == pytest.approx(base[d][3] + gain, rel=1e-4, abs=1e-3), d


def toy_vocabulary(words):
    import numpy as np

    h = np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    n = np.arange(1, words + 1)[::-1].astype(np.int64)
    unit = maxent.rare_unit(h)
    return maxent.Vocabulary(h, n, len(h), int(n.sum()), np.bincount(unit, minlength=maxent.RARE).astype(float), np.bincount(unit, n, minlength=maxent.RARE).astype(float))


@pytest.mark.parametrize(("words", "levels"), [(3, 2), (400, 2), (1100, 3), (20000, 4)])
def test_units_share_the_base_mass_and_every_context_sums_to_one(words, levels):
    import numpy as np

    v = toy_vocabulary(words)
    assert v.levels == levels and v.first_rare == min(words, 16**levels - maxent.RARE)
    assert np.exp(v.log_unit.astype(float)).sum() == pytest.approx(1, abs=1e-4)
    rng = np.random.default_rng(2)
    w = maxent.Weights(levels, 12, [rng.normal(size=(1 << 12, maxent.BRANCHES)).astype(np.float32) for _ in range(levels)])
    units = np.arange(v.first_rare + maxent.RARE)
    for f in rng.integers(0, 2**63, (3, 1, 3), dtype=np.uint64):
        assert np.exp(w.log_prob(v, np.repeat(f, len(units), axis=0), units).astype(float)).sum() == pytest.approx(1, abs=1e-3)


def test_steps_go_down_the_gradient():
    """A first step of tiny rate moves each weight against the slope that finite differences give."""
    import numpy as np
    import pyarrow as pa

    from ridgecast.llm.batches import chunks

    v = toy_vocabulary(40)
    (c,) = chunks(pa.array(["a b a c", "b a", "a a b c a"]))
    row, h = maxent.tokens(c)
    f, unit = maxent.features(row, h), v.look_up(h)[1]
    rng = np.random.default_rng(3)
    w = maxent.Weights(2, 6, [rng.normal(size=(64, maxent.BRANCHES)) * 0.3 for _ in range(2)])
    slope = [np.zeros((64, maxent.BRANCHES)) for _ in range(2)]
    for level in range(2):
        for i in range(64):
            for k in range(maxent.BRANCHES):
                at = w.tables[level]
                keep = at[i, k]
                loss = []
                for e in (1e-3, -1e-3):
                    at[i, k] = keep + e
                    loss.append(-sum(float((x[np.arange(len(b)), b] - np.log(t)).astype(float).sum()) for _, b, x, _, t in w.forward(v, f, unit)))
                at[i, k] = keep
                slope[level][i, k] = (loss[0] - loss[1]) / 2e-3
    moved, sums = w.copy(), [np.zeros(64) for _ in range(2)]
    (c,) = chunks(pa.array(["a b a c", "b a", "a a b c a"]))
    maxent.learn(v, moved, sums, c, 1.0)
    for level in range(2):
        square = (slope[level] ** 2).mean(axis=1)
        assert np.allclose(sums[level], square, atol=2e-2, rtol=2e-2)
        step = moved.tables[level] - w.tables[level]
        assert np.allclose(step, -slope[level] / np.sqrt(square + 1e-2)[:, None], atol=5e-2)


def test_the_model_grows_with_the_corpus():
    assert [maxent.levels_for(n) for n in (0, 100, 1008, 16368, 65520)] == [2, 2, 3, 4, 4]
    assert [maxent.rows_log2(1 << k) for k in (10, 25, 26, 28, 40)] == [15, 15, 16, 18, 18]


def test_rows_move_whole_and_steps_equal_plain_ones():
    """Whether a row and a place fit 32 bits or not."""
    import numpy as np

    rng = np.random.default_rng(8)
    for size in (64, 1 << 18, 1 << 21):
        w = rng.normal(size=(size, maxent.BRANCHES)).astype(np.float32)
        at, grad = rng.integers(0, size, (2048, 3)) // 7 * 7 % size, rng.normal(size=(2048, maxent.BRANCHES)).astype(np.float32)
        assert (maxent._take(w, at[:, 0]) == w[at[:, 0]]).all()
        g = np.zeros((size, maxent.BRANCHES))
        np.add.at(g, at.ravel(), np.repeat(grad, 3, axis=0))
        mean = (g**2).mean(axis=1)
        want, total = w - 0.1 * g / np.sqrt(mean + 1e-2)[:, None], np.zeros(size)
        maxent._step(w, total, at, grad, 0.1)
        assert np.allclose(w, want, atol=1e-4) and np.allclose(total, mean, rtol=1e-4)
