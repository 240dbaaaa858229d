"""Phrase collocations per language from counts of longest windows only.

Every word starts one window of ``ORDER`` words, padded where its piece ends. Only
these windows are counted; Spark's ROLLUP over the lead columns w1 .. w5 then sums
them to the counts of all shorter phrases, because each occurrence of a phrase is
the prefix of exactly one window. The sum over a language is its number of words.

Most windows are of phrases that cannot reach the least count. So the hashes of all
phrases of 1 to 3 words are counted first: every task writes its sorted hashes and
counts as compressed pieces, dealt by ranges of hashes, which costs about two bytes
a distinct phrase of a task and grows in proportion to the input. Hashes that occur
often enough mark bits of a map of ``MAP_BITS`` bits an order, the only thing
broadcast, of fixed size. A window is cut, by padding, before the first word with
which one of its runs of up to three words has no mark; windows cut to nothing are
counted as all padding, so that no word is lost from the totals. A phrase that is
frequent enough is never cut, whatever the sizes of hashes and maps: marks that
stand for others too only let some windows be longer than need be. The counts
themselves are Spark's, of words, and exact.

Scores are products and quotients of exact decimals.

Defined cases: a null text counts as empty, a null language as ``und``; empty
pieces have no words; a text of any length is taken whole; equal scores rank by
count, then by the phrase's UTF-8 bytes; rows repeated count each time; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimkiln.llm.common import materialise, python_tasks, read_table

ORDER = 5
LEAST = 100
TOP = 2000
RUN = 3
HASH_BITS = 34
MAP_BITS = 26
_BLOCK_BITS = 10
_HELD = 3 << 20
_SLICE = 4 << 20
_RANK_PARTS = 64
UNKNOWN_LANG = "und"
PAD = ""
LEADS = [f"w{i}" for i in range(1, ORDER + 1)]

# what a byte of a text becomes: A-Z in lower case, ends of pieces a line feed, tabs a space
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[65:91] += 32
_BYTES[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 10
_BYTES[9] = 32


class _Words:
    """The words of a batch of (lang, text): codes, dictionary, and where pieces end."""

    def __init__(self, langs: pa.Array, texts: pa.Array):
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        plain = pa.Array.from_buffers(pa.large_string(), len(texts), [
            None, pa.py_buffer(offsets - offsets[0]), pa.py_buffer(_BYTES[raw[offsets[0]:offsets[-1]]])])
        pieces = pc.split_pattern(plain, "\n")
        words = pc.split_pattern(pieces.flatten(), " ")
        of_doc = np.diff(pieces.offsets.to_numpy())
        of_piece = np.diff(words.offsets.to_numpy())
        flat = words.flatten()
        full = pc.greater(pc.binary_length(flat), 0)
        coded = flat.filter(full).dictionary_encode()
        self.code = coded.indices.to_numpy().astype(np.int32)
        self.words = coded.dictionary
        self.piece = np.repeat(np.arange(len(of_piece)), of_piece)[full.to_numpy(zero_copy_only=False)]
        named = pc.fill_null(langs, UNKNOWN_LANG).dictionary_encode()
        self.langs = named.dictionary
        self.lang = np.repeat(named.indices.to_numpy().astype(np.int32), of_doc)[self.piece]

    def reach(self) -> np.ndarray:
        """Words from each word to the end of its piece, itself included, at most ORDER."""
        n = len(self.piece)
        out = np.ones(n, np.int8)
        for k in range(1, ORDER):
            out[:n - k] += (self.piece[:n - k] == self.piece[k:]) & (out[:n - k] == k)
        return out

    def hashes(self, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per number of words 1 .. RUN, the places where such a phrase starts and its hashes."""
        reach = self.reach()
        by_word = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.words.cast(pa.large_binary()).to_pylist()),
                              np.uint64, len(self.words))
        by_lang = np.fromiter((xxhash.xxh64_intdigest(x) for x in self.langs.to_pylist()), np.uint64, len(self.langs))
        words = by_word[self.code]
        seen = by_lang[self.lang]
        for k in range(1, RUN + 1):
            last = len(words) - k + 1
            if last > 0:
                seen = _stir(seen[:last] * np.uint64(0x9E3779B97F4A7C15) + words[k - 1:])
            at = np.flatnonzero(reach >= k)
            yield at, seen[at] >> np.uint64(64 - bits)


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[_Words]:
    """The words of slices of about ``_SLICE`` bytes of text, so that work arrays stay small."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        upto, at = np.concatenate(([0], np.cumsum(sizes))), 0
        while at < batch.num_rows:
            last = max(int(np.searchsorted(upto, upto[at] + _SLICE, side="right")) - 1, at + 1)
            yield _Words(batch.column(0).slice(at, last - at), batch.column(1).slice(at, last - at))
            at = last


def _counted(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value once, in order, with its counts added up."""
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)
    return values[first], np.add.reduceat(counts, first) if len(first) else counts


def _packed(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted values as byte planes of their steps, and counts in the narrowest type, compressed."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    kind = next(t for t in ("<u1", "<u2", "<u4", "<u8") if counts.max() <= np.iinfo(t).max)
    return kind[1:].encode() + zlib.compress(steps.tobytes() + counts.astype(kind).tobytes(), 1)


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    kind = np.dtype(f"<{blob[:2].decode()}")
    raw = zlib.decompress(blob[2:])
    n = len(raw) // (8 + kind.itemsize)
    steps = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n).reshape(8, n).T).view("<u8").ravel()
    return np.cumsum(steps, dtype=np.uint64), np.frombuffer(raw, kind, n, 8 * n).astype(np.uint64)


def frequent_marks(docs: DataFrame, least: int, hash_bits: int = HASH_BITS, map_bits: int = MAP_BITS) -> list[bytes]:
    """Compressed pieces of the maps of phrases of 1 .. RUN words that may occur ``least`` times.

    ``docs`` is (lang, text). The maps reach the driver, at most RUN << map_bits
    bits before compression. A piece of hashes is one task's share of a range of
    hashes; a range is added up in one task.
    """
    shift = np.uint64(hash_bits - _BLOCK_BITS)
    inside = np.uint64((1 << (hash_bits - _BLOCK_BITS)) - 1)
    to_map = np.uint64(max(0, hash_bits - map_bits))
    size = 1 << (hash_bits - int(to_map) - _BLOCK_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[] for _ in range(RUN)]
        n = 0

        def pieces() -> Iterator[pa.RecordBatch]:
            for k, parts in enumerate(held):
                if not parts:
                    continue
                values, counts = _counted(*(np.concatenate(p) for p in zip(*parts)))
                cuts = np.searchsorted(values >> shift, np.arange((1 << _BLOCK_BITS) + 1, dtype=np.uint64))
                used = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_arrays([
                    pa.array(used + (k << _BLOCK_BITS), pa.int32()),
                    pa.array([_packed(values[cuts[i]:cuts[i + 1]] & inside, counts[cuts[i]:cuts[i + 1]]) for i in used],
                             pa.binary())], ["block", "counts"])
                parts.clear()

        for words in _batches(batches):
            for k, (_, found) in enumerate(words.hashes(hash_bits)):
                held[k].append(_counted(found, np.ones(len(found), np.uint64)))
                n += len(held[k][-1][0])
            if n > _HELD:
                yield from pieces()
                n = 0
        yield from pieces()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []

        def marks() -> pa.RecordBatch:
            values, counts = _counted(*(np.concatenate(p) for p in zip(*parts)))
            marked = np.zeros(size, bool)
            marked[(values[counts >= least] >> to_map).astype(np.int64)] = True
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array(
                [zlib.compress(np.packbits(marked).tobytes(), 1)], pa.binary())], ["block", "marks"])

        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if block != now:
                    if parts:
                        yield marks()
                    now, parts = block, []
                parts.append(_unpacked(counts))
        if parts:
            yield marks()

    pieces = docs.mapInArrow(count, "block int, counts binary")
    rows = (pieces.repartition("block").sortWithinPartitions("block")
            .mapInArrow(add, "block int, marks binary").toArrow())
    found = dict(zip(rows.column("block").to_pylist(), rows.column("marks").to_pylist()))
    none = zlib.compress(bytes(-(-size // 8)), 1)
    return [found.get(i, none) for i in range(RUN << _BLOCK_BITS)]


def longest_windows(docs: DataFrame, marks: list[bytes], hash_bits: int = HASH_BITS,
                    map_bits: int = MAP_BITS) -> DataFrame:
    """(lang, w1 .. w5, n): the padded windows of ``docs`` (lang, text).

    A window of two words or more is a row; shorter ones come counted per slice.
    """
    shared = docs.sparkSession.sparkContext.broadcast(marks)
    to_map = np.uint64(max(0, hash_bits - map_bits))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.frombuffer(b"".join(map(zlib.decompress, shared.value)), np.uint8)
        maps = whole.reshape(RUN, -1)
        for words in _batches(batches):
            n = len(words.code)
            # may[k][i]: the k + 1 words from i on may be frequent
            may = np.zeros((RUN, n + ORDER), bool)
            for k, (at, found) in enumerate(words.hashes(hash_bits)):
                place = (found >> to_map).astype(np.int64)
                may[k, at] = (maps[k][place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1
            length = np.zeros(n, np.int8)
            open_ = np.ones(n, bool)
            for k in range(ORDER):
                for run in range(min(k + 1, RUN)):
                    open_ &= may[run, k - run:k - run + n]
                length += open_
            yield _rows(words, np.flatnonzero(length > 1), length)
            short = np.flatnonzero(length <= 1)
            first = np.where(length[short] > 0, words.code[short], -1).astype(np.int64)
            keys, counts = np.unique(words.lang[short].astype(np.int64) << 32 | (first + 1), return_counts=True)
            yield _named(words, (keys >> 32), [(keys & 0xFFFFFFFF) - 1] + [np.full(len(keys), -1)] * (ORDER - 1), counts)

    return docs.mapInArrow(windows, "lang string, " + ", ".join(f"{w} string" for w in LEADS) + ", n long")


def _rows(words: _Words, at: np.ndarray, length: np.ndarray) -> pa.RecordBatch:
    padded = np.concatenate([words.code, np.full(ORDER, -1, np.int32)])
    leads = [np.where(length[at] > k, padded[at + k], -1) for k in range(ORDER)]
    return _named(words, words.lang[at], leads, np.ones(len(at), np.int64))


def _named(words: _Words, langs: np.ndarray, leads: list[np.ndarray], counts: np.ndarray) -> pa.RecordBatch:
    """Codes as words; -1 is padding."""
    names = pa.concat_arrays([words.words.cast(pa.large_string()), pa.array([PAD], pa.large_string())])
    return pa.RecordBatch.from_arrays(
        [words.langs.cast(pa.string()).take(pa.array(langs))]
        + [names.take(pa.array(np.where(c < 0, len(names) - 1, c))).cast(pa.string()) for c in leads]
        + [pa.array(counts, pa.int64())], ["lang", *LEADS, "n"])


def phrase_counts(docs: DataFrame, least: int = LEAST, lang_col: str = "lang", text_col: str = "text",
                  hash_bits: int = HASH_BITS, map_bits: int = MAP_BITS) -> DataFrame:
    """(lang, words, f): all phrases of 1 to 5 words that occur ``least`` times, and per
    language its number of words, with no words at all. Written to the shared folder."""
    python_tasks(docs.sparkSession)
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    windows = longest_windows(rows, frequent_marks(rows, least, hash_bits, map_bits), hash_bits, map_bits)
    counted = windows.groupBy("lang", *LEADS).agg(F.sum("n").alias("n"))
    rolled = counted.rollup("lang", *LEADS).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    words = F.filter(F.array(*LEADS), lambda w: w.isNotNull())
    # the bits of the level are the columns summed over, the last lead lowest
    k = F.lit(ORDER) - F.bit_count("level")
    kept = rolled.filter(k >= 0).filter((k == 0) | ((F.col("f") >= least) & (F.element_at(F.array(F.lit("x"), *LEADS), k + 1) != PAD)))
    return materialise(kept.select("lang", words.alias("words"), "f"), "phrase-counts")


def _phrase(words: str | Column) -> Column:
    return F.concat_ws(" ", words)


def _score() -> Column:
    """floor(1000 a n / (l r)) in decimals of 38 digits, whose products are exact."""
    return F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(16,0)))"
                  " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, lang_col: str = "lang",
                 text_col: str = "text", hash_bits: int = HASH_BITS, map_bits: int = MAP_BITS) -> DataFrame:
    """The best phrases of each language: (lang, rank, phrase, a, l, r, n, score)."""
    counts = phrase_counts(docs, least, lang_col, text_col, hash_bits, map_bits)
    # one row a language, written so that its measured size lets it be broadcast: no task gets a whole language
    totals = materialise(counts.filter(F.size("words") == 0).select("lang", F.col("f").alias("n")), "phrase-totals")
    part = counts.filter(F.size("words") > 0).select("lang", _phrase("words").alias("part"), F.col("f").alias("f"))
    candidates = counts.filter(F.size("words") > 1).select(
        "lang", _phrase("words").alias("phrase"), "words", F.col("f").alias("a"))

    size = F.size("words")
    cuts = candidates.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k",
                       _phrase(F.slice("words", 1, F.col("k"))).alias("first"),
                       _phrase(F.slice("words", F.col("k") + 1, size - F.col("k"))).alias("rest"))
    scored = (cuts.join(part.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
              .join(part.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
              .join(totals, "lang"))
    best = (scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(_score().alias("score"), "k", "l", "r")).alias("cut"))
            .select("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r"))

    spans = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(
        F.sequence(F.lit(1), size - n + 1), lambda at: _phrase(F.slice("words", at, n)))))
    inner = (candidates.filter(size > 2).select("lang", F.explode(spans).alias("phrase"), "a")
             .groupBy("lang", "phrase").agg(F.max("a").alias("within")))
    left = best.join(inner, ["lang", "phrase"], "left").filter(F.coalesce(F.col("within") < F.col("a"), F.lit(True)))

    # ranks within parts of a language first, so that no task sorts a whole language
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = left.withColumn("piece", F.pmod(F.xxhash64("phrase"), F.lit(_RANK_PARTS)))
    parts = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "piece").orderBy(*order)))
    ranked = parts.filter(F.col("rank") <= top).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language of ``documents``."""
    return collocations(read_table(spark, sf_dir, "documents").select("lang", "text"))


OP12_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
lists AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \\t]'), lambda x: x <> '') AS words FROM pieces),
totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM lists GROUP BY lang),
starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS pos FROM lists),
grams AS (
  SELECT lang, list_slice(words, pos, pos + k - 1) AS words, count(*) AS f
  FROM starts, range(1, 6) AS t(k) WHERE pos + k - 1 <= len(words) GROUP BY ALL HAVING count(*) >= 100),
counts AS (SELECT lang, words, array_to_string(words, ' ') AS phrase, f FROM grams),
cuts AS (
  SELECT lang, words, phrase, f AS a, unnest(range(1, len(words))) AS k FROM counts WHERE len(words) > 1),
scored AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, t.n, c.k,
         CAST((CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(c.words, 1, c.k), ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(c.words, c.k + 1, len(c.words)), ' ')
  JOIN totals t ON t.lang = c.lang),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, array_to_string(list_slice(words, pos, pos + k - 1), ' ') AS phrase, max(f) AS within
  FROM (SELECT lang, words, f, unnest(range(1, len(words))) AS pos FROM counts WHERE len(words) > 2), range(2, 5) AS t(k)
  WHERE pos + k - 1 <= len(words) AND k < len(words) GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN inner_phrases i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE i.within IS NULL OR i.within < b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""
