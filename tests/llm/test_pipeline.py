"""The whole pipeline against what its operators say on each stage's own input."""

import numpy as np
import pytest

import corpus_pipeline as CP
from dimkiln.llm import decontaminate, quality, simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in CP.STAGES:
        docs = CP.materialise(stage(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def ids(df):
    return [r[0] for r in df.select("doc_id").collect()]


def test_stages_keep_the_columns_of_documents(stages):
    for df in stages[1:-1]:
        assert sorted(df.columns) == sorted(stages[0].columns)


def test_quality_stage(spark, stages):
    import pyarrow as pa

    weights = quality.fit(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    rows = stages[0].select("doc_id", "text").collect()
    keep = quality.scores(pa.array([r.text for r in rows]), weights) >= quality.THRESHOLD
    assert sorted(ids(stages[1])) == sorted(r.doc_id for r, k in zip(rows, keep) if k)


def test_near_duplicate_stage(stages):
    rows = {r.doc_id: simhash.fingerprint(r.text) for r in stages[1].select("doc_id", "text").collect()}
    root = {i: i for i in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in rows:
        for j in rows:
            if i < j and (rows[i] ^ rows[j]).bit_count() <= simhash.DISTANCE:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert sorted(ids(stages[2])) == sorted(i for i in rows if find(i) == i)


def test_decontamination_stage(spark, stages):
    items = [decontaminate.normalise(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def clean(text):
        doc = decontaminate.normalise(text)
        return not any(decontaminate.closest(i, doc)[0] <= decontaminate.budget(len(i)) for i in items)

    rows = stages[2].select("doc_id", "text").collect()
    sample = [r for r in rows if len(r.text) < 1500]
    kept = set(ids(stages[3]))
    assert all((r.doc_id in kept) == clean(r.text) for r in sample)
    assert kept <= {r.doc_id for r in rows}


def test_mixing_stage_repeats_whole_rows(stages):
    before = {tuple(r) for r in stages[3].collect()}
    after = [tuple(r) for r in stages[4].select(*stages[3].columns).collect()]
    assert set(after) <= before
    size = lambda rows: sum(len(r[1]) for r in rows)
    assert 0.6 < size(after) / size(before) < 1.5


def test_token_stage_covers_every_copy(stages):
    rows = sorted((r.start, r.n_tokens, r.doc_id) for r in stages[5].collect())
    assert sorted(r[2] for r in rows) == sorted(ids(stages[4]))
    assert [r[2] for r in rows] == sorted(r[2] for r in rows)
    sizes = np.array([r[1] for r in rows])
    assert [r[0] for r in rows] == (np.cumsum(sizes) - sizes).tolist()


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("false")
    for _, stage in CP.STAGES:
        docs = CP.materialise(stage(spark, docs, SF), "test-empty")
        assert docs.count() == 0


def test_awkward_documents_pass_every_stage(spark):
    """Nulls in any column, empty and very long texts, repeated rows, extra columns of clashing names."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = [(None, None, None, None, None), (9001, None, "en", None, 0), (9002, "", None, "src0", None),
            (9003, "plain words of a text that says little. " * 5000, "en", "src1", 1),
            (9004, "One more short text, told twice.", "en", "src2", 2)]
    rows = spark.createDataFrame(more + more[-1:], docs.schema)
    clash = ("mix_key", "keep_id", "score", "matches", "fp", "text_", "shard", "range", "quality_score")
    docs = docs.unionByName(rows).withColumns({c: CP.quality.F.lit("x") for c in clash})
    columns = docs.columns
    for name, stage in CP.STAGES[:-1]:
        docs = CP.materialise(stage(spark, docs, SF), "test-awkward")
        assert docs.columns == columns, name
        if name == "simhash_near_dedup":
            assert docs.filter("doc_id = 9004").count() <= 1
    out = CP.STAGES[-1][1](spark, docs, SF).collect()
    assert len(out) == docs.count()
    assert sorted(r.start for r in out)[0] == 0
