"""Exact dedup, SimHash and components against brute force, with the awkward inputs."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from dimkiln.llm import exact_dedup, simhash
from dimkiln.llm.components import components

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def roots(prints, distance=3):
    """Smallest signed fingerprint of each component, by comparing all pairs."""
    parent = {p: p for p in prints}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a in prints:
        for b in prints:
            if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= distance:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB \t\n\x0b\x1c\xa0é中,.", max_size=60))
def test_fingerprint_is_the_contract(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_of_a_very_long_text_in_chunks(monkeypatch):
    text = " ".join(f"w{i % 977} x{i % 13}" for i in range(4000))
    want = plain_fingerprint(text)
    assert simhash.fingerprint(text) == want
    monkeypatch.setattr(simhash, "_CHUNK", 17)
    assert simhash.fingerprint(text) == want
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def dense_prints(n, seed):
    """Fingerprints a few bits around one another: a crowd of different texts of one kind."""
    rng = np.random.default_rng(seed)
    base = int(rng.integers(0, 2**63))
    out = set()
    for _ in range(n):
        x = base
        for b in rng.choice(64, size=rng.integers(0, 9), replace=False):
            x ^= 1 << int(b)
        out.add(signed(x))
    return sorted(out)


@pytest.mark.parametrize("dense", [256, 4, 1])
def test_links_find_the_same_components_with_and_without_crowds(spark, dense):
    prints = dense_prints(300, 5) + dense_prints(40, 6) + [0, 1, -1]
    df = spark.createDataFrame([(p,) for p in sorted(set(prints))], "fp long")
    got = {r.node: r.root for r in components(simhash.links(df, 3, dense)).collect()}
    assert {p: got.get(p, p) for p in set(prints)} == roots(set(prints))


def test_every_link_is_within_the_distance(spark):
    df = spark.createDataFrame([(p,) for p in dense_prints(200, 7)], "fp long")
    for dense in (256, 1):
        for r in simhash.links(df, 3, dense).collect():
            assert ((r.u ^ r.v) & (1 << 64) - 1).bit_count() <= 3


def test_query_on_the_given_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {i: signed(plain_fingerprint(t)) for i, t in texts.items()}
    root = roots(set(prints.values()))
    least = {}
    for i, p in prints.items():
        least[root[p]] = min(i, least.get(root[p], i))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op1_simhash(spark, SF).collect()}
    assert got == {i: (f"{p & (1 << 64) - 1:016x}", least[root[p]]) for i, p in prints.items()}


AWKWARD = [(1, "a b c d", "x"), (2, "a b c d", "y"), (2, "a b c d", "y"), (3, None, "z"), (4, "", "z"),
           (None, "a b c d", "w"), (5, "quite another text here", None), (6, "x" * 100000, "v")]


def awkward(spark):
    return spark.createDataFrame(AWKWARD, "doc_id long, text string, fp string")


def test_near_duplicates_of_awkward_rows(spark):
    got = sorted(((r.id, r.component_id) for r in simhash.near_duplicates(awkward(spark)).collect()), key=str)
    assert got == sorted([(1, 1), (2, 1), (2, 1), (3, 3), (4, 3), (None, 1), (5, 5), (6, 6)], key=str)
    kept = simhash.keep_one(awkward(spark))
    assert kept.columns == ["doc_id", "text", "fp"]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 3, 5, 6]
    assert simhash.near_duplicates(awkward(spark).filter("false")).count() == 0


def test_keep_one_does_not_depend_on_the_order_of_rows(spark):
    a, b = "one two three four", "quite another text altogether here"
    rows = [(0, a), (1, a), (1, b), (None, b + "!"), (None, "only nulls"), (None, "only nulls")]
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(1 + seed)
        kept = simhash.keep_one(df).collect()
        assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(
            [(0, a), (1, b), (None, b + "!"), (None, "only nulls")], key=str)


def test_exact_dedup_of_awkward_rows(spark):
    got = exact_dedup.exact_dedup(awkward(spark)).collect()
    rows = sorted(((r.id, r.keep_id, r.group_size, r.kept) for r in got), key=str)
    assert rows == sorted([(1, 2, 4, False), (2, 2, 4, True), (2, 2, 4, False), (None, 2, 4, False), (3, 4, 2, False),
                           (4, 4, 2, True), (5, 5, 1, True), (6, 6, 1, True)], key=str)
    assert {r.digest for r in got if r.id == 3} == {hashlib.sha256(b"").hexdigest()}
    assert exact_dedup.exact_dedup(awkward(spark).filter("false")).count() == 0
    only_null = awkward(spark).filter("doc_id is null")
    assert [(r.keep_id, r.kept) for r in exact_dedup.exact_dedup(only_null).collect()] == [(None, True)]


def test_index_keeps_the_largest_id_in_any_order_of_batches(spark, scratch):
    first = [(1, "a"), (2, "b"), (9, "c")]
    later = [(7, "a"), (8, "c"), (None, "d")]
    for n, batches in enumerate(((first, later, later), (later, first, first))):
        path = f"{scratch}/index{n}"
        for i, batch in enumerate(batches):
            with exact_dedup.DigestIndex(spark, path, buckets=4) as index:      # another session opens the path
                index.add(exact_dedup.stage_digests(spark.createDataFrame(batch, "doc_id long, text string").repartition(i + 1)))
        with exact_dedup.DigestIndex(spark, path, buckets=4) as index:
            assert sorted((r.keep_id for r in index.read().collect()), key=str) == [2, 7, 9, None]
            for batch, kept in ((first, {1: False, 2: True, 9: True}), (later, {7: True, 8: False, None: True})):
                staged = exact_dedup.stage_digests(spark.createDataFrame(batch, "doc_id long, text string"))
                assert {r.id: r.kept for r in exact_dedup.decisions(staged, index).collect()} == kept
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("digest_index_")]


def test_a_batch_offered_twice_gets_the_same_decisions(spark, scratch):
    rows = [(f"id {i % 40}", f"text {i % 30}", i) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id string, text string, extra int")
    runs = [sorted((r.id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(
        df.repartition(n), f"{scratch}/index", batches=b).collect()) for n, b in ((3, 2), (1, 3), (7, 1))]
    assert runs[0] == runs[1] == runs[2] and sum(r[3] for r in runs[0]) == 30


def test_the_index_side_of_the_anti_join_is_not_shuffled(spark, scratch):
    index = exact_dedup.DigestIndex(spark, f"{scratch}/index", buckets=4)
    batch = exact_dedup.stage_digests(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    index.add(batch)
    joined = batch.groupBy("digest").count().join(index.rows().select("digest").hint("merge"), "digest", "left_anti")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    right = plan[plan.index("SortMergeJoin"):].split("\n")
    scan = next(i for i, line in enumerate(right) if "digest_index_" in line)
    assert "SortMergeJoin" in plan and "Exchange" not in right[scan - 1] and "Exchange" not in right[scan - 2]


def test_a_group_with_a_third_of_all_rows(spark):
    df = spark.range(30000).selectExpr("id as doc_id", "if(id % 3 = 0, 'the copy', concat('text ', id)) as text")
    got = exact_dedup.exact_dedup(df.repartition(8))
    assert got.filter("group_size = 10000").count() == 10000
    assert got.filter("kept").count() == 20001
