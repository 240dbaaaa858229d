"""Personal data: strict spans against Python's regex engine, bootstrapping on a fixture."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from dimkiln.llm import pii

KINDS = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
]


def passes(kind, value):
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    return {k: [(m.start(), m.end()) for m in r.finditer(text or "") if passes(k, m.group())] for k, r in KINDS}


def random_texts(n):
    rng = random.Random(3)
    parts = ["a.b@c.d", "@", "x@y", ".", "..", "_d@e.f", "1.2.3.4", "255.256.1.1", "00001.2.3.4", "5.6.7.8.9", " ", "-",
             "+1 (476) 555-6291", "+", "(", ")", "4111 1111 1111 1111", "4111111111111111", "4111-1111", "7", "99", "é😀",
             "\n", "word", "%+-@h-h.co", "1234567890123456789012", "0"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_strict_spans_match_the_plain_expressions(spark):
    texts = random_texts(1500) + [None, "", "9" * 30000, "a" * 30000, "1-" * 20000, "a@b" + ".c" * 20000, "+1" + "(" * 9000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.scan(df).select("id", *pii.KINDS).collect()
    assert len(found) == len(texts)
    for row in found:
        want = base(texts[row.id])
        got = {k: [(m.start, m.end) for m in row[k]] for k in pii.KINDS}
        assert got == want, texts[row.id][:200]


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in pii.op6_pii(spark, sf).collect():
        want = base(texts[r.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, _ in KINDS for a, b in want[k])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(want[k]) for k, _ in KINDS]
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) <= set(r.spans.split(","))


def bootstrapped():
    """Seeds after 'hotline:' induce a pattern; numbers without a plus sign follow it elsewhere."""
    rows = [(i, f"some words hotline: +1 476 555 {6000 + i} and more words") for i in range(6)]
    rows += [(10, "call our hotline: 476 555 7777 today"), (11, "the count is 476 555 8888 items"),
             (12, "hotline: nothing"), (13, None), (13, ""), (None, "hotline: 476 555 9999")]
    rows += [(20 + i, f"the the {i} count is {i}") for i in range(30)]
    return rows


def test_patterns_discover_unseen_identifiers(spark):
    df = spark.createDataFrame(bootstrapped(), "doc_id long, text string")
    out = [(r.id, [(f.kind, f.start, f.end) for f in r.found]) for r in pii.personal_data(df).collect()]
    assert len(out) == len(bootstrapped())
    found = sorted(((i, f) for i, f in out if f), key=str)
    assert found == [(10, [("phone", 18, 30)]), (None, [("phone", 9, 21)])]


def test_confidence_is_a_share_of_all_occurrences(spark):
    # the word stands next to seeds, but far more often next to other things
    rows = [(i, f"of +1 476 555 {6000 + i}") for i in range(6)] + [(9, "of 476 555 7777")]
    rows += [(100 + i, "of this of that") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(not r.found for r in pii.personal_data(df).collect())


def phones(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(r.id for r in pii.personal_data(df).collect() if any(f.kind == "phone" for f in r.found))


def test_more_loose_than_strict_instances_beside_a_word(spark):
    rows = [(i, f"hotline: +1 476 555 {6000 + i}") for i in range(10)]
    rows += [(100 + i, f"hotline: 476 555 {7000 + i}") for i in range(30)]
    assert phones(spark, rows) == list(range(100, 130))


def test_scores_settle(spark):
    # seeds are half, loose instances .4 and other things .1 of the word: the limit is .5 / .6
    rows = [(i, f"hotline: +1 476 555 {6000 + i}") for i in range(50)]
    rows += [(100 + i, f"hotline: 476 555 {7000 + i}") for i in range(40)]
    rows += [(200 + i, "hotline: nothing") for i in range(10)]
    assert phones(spark, rows) == list(range(100, 140))


def test_a_score_reaches_patterns_over_shared_instances(spark):
    # 'tel' has 3 seeds for 2 other things; a sure pattern knows its loose instances from elsewhere
    rows = [(i, f"hotline: +1 476 555 {6000 + i}") for i in range(5)]
    rows += [(100 + i, f"hotline: 476 555 {7000 + i}") for i in range(10)]
    rows += [(200 + i, f"tel 476 555 {7000 + i}") for i in range(10)] + [(300, "tel 476 555 9999")]
    rows += [(400 + i, f"tel +1 476 555 {8000 + i}") for i in range(3)] + [(500 + i, "tel none") for i in range(2)]
    assert phones(spark, rows) == [*range(100, 110), *range(200, 210), 300]


def test_loose_instances_alone_do_not_make_a_pattern_sure(spark):
    rows = [(i, f"id +1 476 555 {6000 + i}") for i in range(3)] + [(10 + i, "id none") for i in range(3)]
    rows += [(100 + i, f"id 476 555 {7000 + i}") for i in range(60)]
    assert phones(spark, rows) == []


def test_what_is_glued_to_a_span_is_no_pattern(spark):
    rows = [(i, f"word$$$ 411111111111111{i}$$$ other$$$ and 4111 1111 1111 1111$$$ x 5500 0000 0000 0004$$$") for i in range(6)]
    df = spark.createDataFrame(rows + [(9, "1234567890123456$$$ tail")], "doc_id long, text string")
    assert not any(f.kind == "card" for r in pii.personal_data(df).filter("id = 9").collect() for f in r.found)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, extra int")
    assert pii.personal_data(df).count() == 0


@pytest.mark.parametrize("digits,ok", [("4111111111111111", True), ("4111111111111112", False), ("0", True)])
def test_luhn(spark, digits, ok):
    assert spark.range(1).select(pii.luhn(F.lit(digits))).first()[0] is ok


def test_neighbour_words_are_whole_however_long_or_far(spark):
    long, gap = "w" * 100, " " * 70
    rows = [f"{long} +1 476 555 {1000 + i}" for i in range(5)] + [f"{long} 476 555 7777"]
    rows += [f"{long} other{i}" for i in range(80)]                       # mostly beside other things
    rows += [f"hotline{gap}+1 476 555 {2000 + i}" for i in range(5)] + [f"hotline{gap}476 555 8888"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.id: [tuple(f) for f in r.found] for r in pii.personal_data(df).collect()}
    assert found[5] == [] and found[rows.index(f"hotline{gap}476 555 8888")] == [("phone", 77, 89)]


def test_labels_glued_to_identifiers_are_patterns(spark):
    rows = [f"call Tel:+1 476 555 {1000 + i} now" for i in range(10)] + ["call tel:476 555 9999 now"]
    rows += [f"see ref:+1 476 555 {3000 + i}" for i in range(4)] + [f"see ref:x{i}" for i in range(40)] + ["see ref:476 555 8888"]
    rows += ["x" * 90 + ":476 555 1212"] + ["x" * 90 + f":+1 476 555 {4000 + i}" for i in range(5)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {rows[r.id]: [tuple(f) for f in r.found] for r in pii.personal_data(df).collect() if r.found}
    assert found == {"call tel:476 555 9999 now": [("phone", 9, 21)],
                     "x" * 90 + ":476 555 1212": [("phone", 91, 103)]}
