"""Benchmark decontamination by pigeonhole edit matching.

Texts are lower-cased and white space is collapsed. A benchmark item of n
characters may be found with up to ``rate * n`` edits (insertions, deletions,
substitutions of characters). It is split into one piece more than that budget,
so any passage within the budget holds at least one piece unchanged. An
Aho-Corasick automaton over all pieces finds exact piece hits in every document
in one pass; each hit fixes where the item would have to start, hits that agree
within the budget are one candidate, and Myers' bit-parallel algorithm gives the
smallest edit distance of the item to any passage of the candidate's window.
Items below ``min_chars`` normalised characters are found exactly only, as whole
words: where no letter or digit touches one at their edges. The first such place
is reported.

What counts is the whole item: a passage that leaves out or changes more than
its budget (an item cut by the end of a document, the first 50 of 59 words) is
no match.

The benchmark is the stated query set: it is taken in blocks of at most
``block_bytes`` of item text, each of which is broadcast, and every document is
searched for every block, one block after the other. Nothing of the documents
leaves their tasks but the matches (and, with several blocks, a row tag).

Defined cases: null and empty texts and items match nothing; repeated item
ids are told apart by their place and each match is reported; repeated documents
are each searched; an empty table gives an empty result; extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimkiln.llm.common import free_name, materialise, python_tasks, read_table

EDIT_RATE = 0.08
MIN_CHARS = 24
BLOCK_BYTES = 16 << 20

MATCH = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("edits", T.IntegerType()),
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(n: int, rate: float = EDIT_RATE) -> int:
    return int(n * rate)


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """(offset, piece): the item in edits + 1 pieces of nearly equal length."""
    n, k = len(item), edits + 1
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def closest(item: str, window: str) -> tuple[int, int]:
    """(distance, end): the least edits from ``item`` to any substring of ``window``.

    Myers' algorithm (1999) with Hyyrö's formulation; a Python integer is the bit
    vector, so an item of any length is one word. ``end`` is the first place
    where the least distance is reached.
    """
    m = len(item)
    eq: dict[str, int] = {}
    for i, ch in enumerate(item):
        eq[ch] = eq.get(ch, 0) | (1 << i)
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for at, ch in enumerate(window, 1):
        x = eq.get(ch, 0)
        vertical = x | down
        horizontal = (((x & up) + up) ^ up) | x
        plus = down | (full & ~(horizontal | up))
        minus = up & horizontal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = (plus << 1) & full
        minus = (minus << 1) & full
        up = minus | (full & ~(vertical | plus))
        down = plus & vertical
        if score < best:
            best, end = score, at
    return best, end


class Matcher:
    """All items of one block: the automaton and the items' texts and budgets."""

    def __init__(self, items: list[tuple[int, str]], rate: float = EDIT_RATE, min_chars: int = MIN_CHARS):
        self.items: list[tuple[int, str, int, bool]] = []
        found: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            text = normalise(text)
            if not text:
                continue
            short = len(text) < min_chars
            k = 0 if short else budget(len(text), rate)
            for offset, piece in pieces(text, k):
                found.setdefault(piece, []).append((len(self.items), offset))
            self.items.append((item_id, text, k, short))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        if found:
            self.automaton.make_automaton()

    def search(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, edits, start, end) of the closest passage for each item within budget.

        ``start`` and ``end`` are places in the normalised text.
        """
        doc = normalise(text)
        if not self.items or not doc:
            return []
        starts: dict[int, set[int]] = {}
        for last, (size, places) in self.automaton.iter(doc):
            for number, offset in places:
                starts.setdefault(number, set()).add(last + 1 - size - offset)
        out = []
        for number, where in starts.items():
            item_id, item, k, short = self.items[number]
            if short:
                whole = [a for a in where if _whole_words(doc, a, a + len(item))]
                out += [(item_id, 0, a, a + len(item)) for a in sorted(whole)[:1]]
                continue
            best = None
            for low, high in _merged(sorted(where), k):
                a, b = max(0, low - k), min(len(doc), high + len(item) + k)
                if b - a < len(item) - k:
                    continue
                edits, end = closest(item, doc[a:b])
                if edits <= k and (best is None or edits < best[0]):
                    best = (edits, a + end)
            if best:
                back, length = closest(item[::-1], doc[max(0, best[1] - len(item) - k):best[1]][::-1])
                out.append((item_id, best[0], best[1] - length if back == best[0] else best[1] - len(item), best[1]))
        return sorted(out)


def _whole_words(doc: str, start: int, end: int) -> bool:
    """Whether no word goes on beyond either edge of the passage."""
    before, after = doc[max(0, start - 1):start + 1], doc[end - 1:end + 1]
    return not any(len(pair) == 2 and pair[0].isalnum() and pair[1].isalnum()
                   for pair in (before if start else "", after))


def _merged(starts: list[int], k: int) -> Iterator[tuple[int, int]]:
    """Runs of starts whose neighbours are at most 2 k + 1 apart, in one window each."""
    low = high = starts[0]
    for s in starts[1:]:
        if s - high > 2 * k + 1:
            yield low, high
            low = s
        high = s
    yield low, high


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most ``block_bytes`` of text (or of one item)."""
    block: list[tuple[int, str]] = []
    size = 0
    rows = benchmark.select(F.col(id_col).cast("long"), F.col(text_col)).filter(F.col(text_col).isNotNull())
    for item_id, text in rows.toLocalIterator():
        n = len(text.encode("utf-8", "surrogatepass"))
        if block and size + n > block_bytes:
            yield block
            block, size = [], 0
        block.append((item_id, text))
        size += n
    if block:
        yield block


def _match_column(spark: SparkSession, items: list[tuple[int, str]], text: Column, rate: float, min_chars: int) -> Column:
    shared = spark.sparkContext.broadcast(items)

    @F.pandas_udf(MATCH)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(shared.value, rate, min_chars)
        for texts in batches:
            yield pd.Series([matcher.search(t if isinstance(t, str) else None) for t in texts])

    # evaluated once: Spark would repeat a deterministic call in the filter it infers
    return search.asNondeterministic()(text)


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, out_col: str = "matches", text_col: str = "text",
                      rate: float = EDIT_RATE, min_chars: int = MIN_CHARS,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with the array of matches of each text.

    A benchmark of one block is searched in one pass without a shuffle. With more,
    the documents are written with a row tag and each block's matches are written
    before the next block is taken: one block is on the driver and one automaton
    in a task at any time, however many blocks there are.
    """
    spark = docs.sparkSession
    python_tasks(spark)
    blocks = item_blocks(benchmark, block_bytes=block_bytes)
    items = next(blocks, None)
    if items is None:
        return docs.withColumn(out_col, F.array().cast(MATCH))
    following = next(blocks, None)
    if following is None:
        return docs.withColumn(out_col, _match_column(spark, items, F.col(text_col), rate, min_chars))
    tag = free_name(docs, "row_tag")
    tagged = materialise(docs.withColumn(tag, F.monotonically_increasing_id()), "contamination-docs")
    found = None
    while items is not None:
        column = _match_column(spark, items, F.col(text_col), rate, min_chars)
        part = materialise(tagged.select(F.col(tag).alias("tag"), column.alias("m")).filter(F.size("m") > 0),
                           "contamination-matches")
        found = part if found is None else found.union(part)
        items, following = following, next(blocks, None) if following is not None else None
    by_row = found.groupBy("tag").agg(F.array_sort(F.flatten(F.collect_list("m"))).alias("m"))
    return (tagged.join(by_row, F.col(tag) == F.col("tag"), "left")
            .select(*docs.columns, F.coalesce("m", F.array().cast(MATCH)).alias(out_col)))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a passage of an item."""
    name = free_name(docs, "benchmark_matches")
    return benchmark_matches(docs, benchmark, name, text_col).filter(F.size(name) == 0).drop(name)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document of ``documents`` and item of ``benchmark`` found in it."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = benchmark_matches(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.inline("matches"))
