"""The pipeline's stages against brute force on the small tables."""

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ridgecast.llm.queries import QUERIES, llm_oracle_sql, llm_queries
from ridgecast.llm.quality import quality


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf).cache()
        out.append((name, docs))
    return dict(out)


def pairs(df, key="doc_id"):
    return [(r[key], r.text) for r in df.select(key, "text").collect()]


def test_columns(stages):
    names = list(stages)
    for n in names[:-1]:
        assert stages[n].columns == stages["documents"].columns


def test_quality_stage(spark, sf, stages):
    bad = quality(stages["documents"], spark.read.parquet(f"{sf}/labels.parquet")).where("not keep")
    assert {r.doc_id for r in stages["documents"].collect()} - {r.doc_id for r in stages["quality"].collect()} == {r.doc_id for r in bad.collect()}


def test_near_duplicate_stage(stages):
    want = {d for d, (_, c) in brute.jaccard(pairs(stages["quality"])).items() if c == d}
    assert sorted(r.doc_id for r in stages["near_duplicates"].collect()) == sorted(want)


def test_decontamination_stage(spark, sf, stages):
    items = pairs(spark.read.parquet(f"{sf}/benchmark.parquet"), "item_id")
    want = {d for d, r in brute.decontaminate(pairs(stages["near_duplicates"]), items).items() if not r[4]}
    assert {r.doc_id for r in stages["decontamination"].collect()} == want


def test_secrets_stage(stages):
    before, after = dict(pairs(stages["decontamination"])), dict(pairs(stages["secrets"]))
    assert before.keys() == after.keys()
    for d, t in after.items():
        assert brute.secrets(t)[:3] == (0, 0, 0)
        assert (t == before[d]) == (not brute.secrets(before[d])[3])


def test_packing_stage(stages):
    text = dict(pairs(stages["secrets"]))
    got = stages["packing"].groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()
    assert {r.doc_id: r.n for r in got} == {d: len(brute.space_words(t)) + 1 if brute.space_words(t) else 0 for d, t in text.items()}


def test_run_equals_stages(spark, sf, stages):
    assert corpus_pipeline.run(spark, sf).count() == stages["packing"].count()


def test_stages_on_awkward_rows(spark, sf, docs, rows, empty):
    """Nulls, null ids, repeated ids and rows, empty and very long texts, columns with clashing names: each stage on all that the last one kept."""
    items = pairs(spark.read.parquet(f"{sf}/benchmark.parquet"), "item_id")
    extra = spark.createDataFrame([(25, "another text " * 9), (700, items[0][1]), (None, items[0][1]), (701, "token=" + "q" * 20)], "doc_id long, text string")
    at = docs.unionByName(extra, allowMissingColumns=True)
    before = [(r.doc_id, r.text) for r in at.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, at, sf).cache()
        after = [(r.doc_id, r.text) for r in out.collect()]
        assert out.columns == docs.columns, name
        if name == "near_duplicates":
            ids = {d for d, (_, c) in brute.jaccard([x for x in before if x[0] is not None and x[0] != 25]).items() if c == d}
            assert {d for d, _ in after} - {25, None} == ids and [d for d, _ in after].count(None) == [d for d, _ in before].count(None)
        elif name == "decontamination":
            bad = brute.decontaminate(list(enumerate(t for _, t in before)), items)
            assert sorted(map(str, after)) == sorted(str(x) for i, x in enumerate(before) if not bad[i][4])
            assert (700, items[0][1]) not in after and (None, items[0][1]) not in after
        elif name == "secrets":
            assert sorted(str(d) for d, _ in after) == sorted(str(d) for d, _ in before) and all(brute.secrets(t)[:3] == (0, 0, 0) for _, t in after)
        else:
            assert set(after) <= set(before)
        at, before = out, after
    packed = corpus_pipeline.STAGES[-1][1](spark, at, sf)
    assert packed.agg(F.sum("n_tokens")).first()[0] == sum(len(brute.space_words(t)) + 1 for _, t in before if brute.space_words(t))
    at = empty
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, sf)
        assert at.count() == 0


def test_every_operator_is_registered():
    assert [f.__name__.split("_")[0] for f in QUERIES] == [*(f"op{n}" for n in range(1, 11)), "pipeline"]
    assert set(llm_oracle_sql()) <= set(llm_queries())


@pytest.mark.parametrize("name", sorted(llm_oracle_sql()))
def test_query_equals_its_oracle(spark, sf, name):
    import os

    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{os.path.join(sf, t)}.parquet'")
    want = con.sql(llm_oracle_sql()[name]).df()
    got = llm_queries()[name](spark, sf).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    plain = lambda d: sorted(tuple(map(str, r)) for r in d[sorted(d.columns)].itertuples(index=False))
    assert plain(got) == plain(want)
