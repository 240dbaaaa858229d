"""Token ids in Huffman-coded blocks, in ascending document order.

Writing takes these steps, each a Spark job over all documents:

1. every whole text is encoded with the tokenizers library and the ids, with the
   end id, are written as they come (``ids`` table in the shared folder);
2. global counts per id give a length-limited canonical Huffman code; its code
   lengths are the ``codebook`` of the output;
3. the documents are dealt to ranges of document ids and sorted, and each range
   is coded, every document on a byte boundary with a checkpoint for every 256
   ids, and packed into blocks of about 65,536 ids, which are the ``blocks`` of the
   output. The number of ranges follows from the number of ids; documents that
   repeat an id, or have none, are told apart by a row tag of the written ids, so
   they are divided between ranges too.

A block is one row of a Parquet file: (range, block, n_ids, payload, and per
document its id, number of ids and checkpoints as bit offsets in the payload).
Blocks can be decoded alone, and from any checkpoint on. Reading needs the number
of ids before each block: sums per range go through the driver (their number is
a parameter), sums inside a range are a window.

Only vocabulary-sized data (counts, code lengths) and one number per range reach
the driver.

Defined cases: a null text counts as empty and is the end id alone; a null
document id sorts first; rows repeating an id lie side by side; an empty table
gives empty files; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark import TaskContext
from tokenizers import Tokenizer

from dimkiln.llm import huffman
from dimkiln.llm.common import python_tasks, read_table, scratch_path

END_ID = 2
RANGE_IDS = 1 << 24
BLOCK_IDS = 1 << 16
CACHED_WORDS = 3 << 19
_LONG_WORD = 64
_SLICE = 4 << 20


# punctuation at the end of a word, behind a letter or digit. Beyond ASCII only Latin
# letters: lower-casing or composing others, and U+0130, can leave a combining mark
# behind, and that or a control character would join the punctuation.
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
_TAILED = ("[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]"
           "[\\x21-\\x2f\\x3a-\\x40\\x5b-\\x60\\x7b-\\x7e]+$")


_PROBE = "The Quick  (brown) fox's\tÉtude, 12.5\nnaïve -- end."


def _lower_cases(json_text: str) -> bool:
    """Whether the tokenizer's normaliser lower-cases and drops white space."""
    def steps(rule) -> list[str]:
        if not isinstance(rule, dict):
            return []
        return [rule.get("type", ""), *(t for part in rule.get("normalizers", ()) for t in steps(part))]

    return "Lowercase" in steps(json.loads(json_text).get("normalizer"))


class CachedTokenizer:
    """The tokenizer with the ids of short words remembered.

    Where the tokenizer's normaliser and pre-tokenizer never look across white
    space, and its special strings hold none, a text's ids are the ids of its
    white-space separated words, one after the other. A text that has ``<|`` is
    encoded whole, as lower-casing could make a special string of it. That holds
    for lower-casing tokenizers with word ends; what the file says and a probe text
    decide on loading, and with any other tokenizer all texts are encoded whole.
    """

    def __init__(self, json_text: str, dtype: str):
        self.tokenizer = Tokenizer.from_str(json_text)
        self.dtype = np.dtype(dtype)
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        ends = [(i, t) for t, i in self.tokenizer.get_vocab().items()]
        self.is_end = np.zeros(max(i for i, _ in ends) + 1, bool)
        self.is_end[[i for i, t in ends if t.endswith("</w>")]] = True
        self.by_word = _lower_cases(json_text) and bool(self.is_end.any()) and self._ids(_PROBE) == [
            i for w in _PROBE.split() for i in self._ids(w.lower())]

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _bytes(self, ids) -> bytes:
        return np.asarray(ids, self.dtype).tobytes()

    def _learn(self, words: list[bytes]) -> None:
        """Remember the ids of new words.

        Punctuation at a word's end is a pre-token of its own after a letter or
        digit, so it is taken apart: stems repeat far more often than words.

        Words are kept in two generations of half the bound each, so that those
        in use outlive the change of generations.
        """
        if len(self.words) > CACHED_WORDS // 2:
            self.words, self.older = {}, self.words
        words = self._recalled(words)
        text = pa.array(words, pa.binary()).cast(pa.string())
        tailed = pc.match_substring_regex(text, _TAILED)
        stems = pc.if_else(tailed, pc.utf8_rtrim(text, _MARKS), text)
        plain = pc.utf8_is_alpha(stems).to_pylist()
        stems = _cut(stems.cast(pa.large_binary()))
        known = self.words
        letters, others = {}, {}
        for w, stem, alpha in zip(words, stems, plain):
            if stem not in known:
                (letters if alpha else others)[stem] = None
            if len(stem) < len(w) and (tail := w[len(stem):]) not in known:
                others[tail] = None
        # words of letters alone are one pre-token each, whose last id ends the word
        letters = self._recalled(letters)
        groups = [letters[i:i + 64] for i in range(0, len(letters), 64)]
        joined = self.tokenizer.encode_batch_fast([b" ".join(g).decode() for g in groups], add_special_tokens=False)
        for group, encoded in zip(groups, joined):
            ids = np.array(encoded.ids, self.dtype)
            cuts = np.flatnonzero(self.is_end[ids]) + 1
            if len(cuts) == len(group) and cuts[-1] == len(ids):
                raw, ends = ids.tobytes(), (cuts * self.dtype.itemsize).tolist()
                known.update(zip(group, map(raw.__getitem__, map(slice, [0, *ends[:-1]], ends))))
            else:
                known.update((w, self._bytes(self._ids(w.decode()))) for w in group)
        known.update((w, self._bytes(self._ids(w.decode()))) for w in self._recalled(others))
        known.update((w, known[stem] + known[w[len(stem):]]) for w, stem in zip(words, stems) if len(stem) < len(w))

    def _recalled(self, words) -> list[bytes]:
        """Take over what the older generation has of ``words``; return the others."""
        if not self.older:
            return list(words)
        old = {w: self.older.get(w) for w in words}
        self.words.update((w, v) for w, v in old.items() if v is not None)
        return [w for w, v in old.items() if v is None]

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, without an end id."""
        return self.encode_batch(pa.array([text], pa.large_string()))[0].tobytes()

    def encode_batch(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has; ``end`` is put behind each.

        The words of all texts are coded first; only distinct ones are looked up,
        and the ids are gathered by word code.
        """
        n = len(texts)
        if not self.by_word:
            ids = [self._ids(t) + [end] * (end is not None) for t in texts.to_pylist()]
            return (np.array([i for x in ids for i in x], self.dtype), np.array([len(x) for x in ids], np.int64))
        whole = np.flatnonzero(pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False))
        special = [self._bytes(self._ids(texts[int(i)].as_py())) for i in whole]
        if len(whole):
            texts = pc.if_else(pc.match_substring(texts, "<|"), "", texts)
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.large_string())))
        per_text = np.diff(split.offsets.to_numpy())
        words = split.flatten()
        full = pc.greater(pc.binary_length(words), 0)
        coded = words.filter(full).dictionary_encode()
        known = self._of_words(_cut(coded.dictionary.cast(pa.large_binary())))
        text_of = np.repeat(np.arange(n), per_text)[full.to_numpy(zero_copy_only=False)]
        # word codes, then one code for each text that is encoded whole, then the end id
        entries = pa.array([*known, *special, b"" if end is None else self._bytes([end])], pa.large_binary())
        per = np.bincount(text_of, minlength=n) + 1
        code = np.full(len(text_of) + n, len(entries) - 1, np.int32)
        code[np.arange(len(text_of)) + text_of] = coded.indices.to_numpy()
        ends = np.cumsum(per)
        if len(whole):  # such a text has no words left: its own code goes before its end
            code = np.insert(code, ends[whole] - 1, len(known) + np.arange(len(whole)))
            per[whole] += 1
            ends = np.cumsum(per)
        taken = entries.take(pa.array(code))
        upto = np.frombuffer(taken.buffers()[1], np.int64)[:len(code) + 1] // self.dtype.itemsize
        ids = np.frombuffer(taken.buffers()[2] or b"", self.dtype)[:upto[-1]]
        return ids, np.diff(upto[ends], prepend=0)

    def _of_words(self, words: list[bytes]) -> list[bytes]:
        found = list(map(self.words.get, words))
        if None in found:
            new = [i for i, f in enumerate(found) if f is None]
            self._learn([words[i] for i in new if len(words[i]) <= _LONG_WORD])
            get = self.words.get
            for i in new:  # long words are not remembered
                found[i] = get(words[i]) or self._bytes(self._ids(words[i].decode()))
        return found


def _cut(words: pa.Array) -> list[bytes]:
    """The values of a large binary array that starts at its buffers' start."""
    ends = np.frombuffer(words.buffers()[1], np.int64)[:len(words) + 1].tolist()
    raw = words.buffers()[2].to_pybytes() if len(words) else b""
    return list(map(raw.__getitem__, map(slice, ends[:-1], ends[1:])))


_TOKENIZERS: dict[str, CachedTokenizer] = {}


def _tokenizer(json_text: str, dtype: str) -> CachedTokenizer:
    """One tokenizer per worker process; its memory of words outlives a task."""
    key = hashlib.sha1(json_text.encode()).hexdigest()
    if key not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        _TOKENIZERS[key] = CachedTokenizer(json_text, dtype)
    return _TOKENIZERS[key]


@dataclass(frozen=True)
class TokenFiles:
    """Where one output lies."""

    path: str

    @property
    def ids(self) -> str:
        return f"{self.path}/ids"

    @property
    def codebook(self) -> str:
        return f"{self.path}/codebook"

    @property
    def blocks(self) -> str:
        return f"{self.path}/blocks"


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def write_ids(docs: DataFrame, files: TokenFiles, tokenizer_json: str, vocabulary: int, end_id: int,
              id_col: str, text_col: str) -> DataFrame:
    """The (doc_id, tag, n, ids) table; ids are little-endian, 2 bytes each where the vocabulary allows.

    ``tag`` is unique; it is fixed by the write.
    """
    spark = docs.sparkSession
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"
    shared = spark.sparkContext.broadcast(tokenizer_json)

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(shared.value, dtype)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "").cast(pa.large_string())
            bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
            for a, b in _slices(bounds):
                ids, n = tokenizer.encode_batch(texts.slice(a, b - a), end_id)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), _blobs(ids, n)], ["doc_id", "n", "ids"])

    id_type = docs.schema[id_col].dataType.simpleString()
    made = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        tokenise, f"doc_id {id_type}, n long, ids binary").select(
        "doc_id", F.monotonically_increasing_id().alias("tag"), "n", "ids")
    made.write.option("compression", "zstd").parquet(files.ids)
    return spark.read.schema(made.schema).parquet(files.ids)


def _blobs(ids: np.ndarray, n: np.ndarray) -> pa.Array:
    """One binary value per text."""
    ends = np.concatenate(([0], np.cumsum(n))) * ids.dtype.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(ends.astype(np.int64)),
                                                             pa.py_buffer(np.ascontiguousarray(ids))]).cast(pa.binary())


def id_counts(ids: DataFrame, vocabulary: int) -> np.ndarray:
    """Occurrences of every id over all documents; a partial count per task."""
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for blob in batch.column(0):
                total += np.bincount(np.frombuffer(blob.as_buffer(), dtype), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    rows = ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(vocabulary, np.int64)
    out[rows.column("id").to_numpy()] = rows.column("n").to_numpy()
    return out


def _concat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a binary array."""
    column = column.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def _slices(bounds: np.ndarray, size: int = _SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes each, so that work arrays stay small."""
    at, n = 0, len(bounds) - 1
    while at < n:
        last = max(int(np.searchsorted(bounds, bounds[at] + size, side="right")) - 1, at + 1)
        yield at, last
        at = last


def ranges_for(total: int, spark: SparkSession) -> int:
    """Ranges of about RANGE_IDS ids each, and enough for every shuffle task."""
    return max(-(-total // RANGE_IDS), int(spark.conf.get("spark.sql.shuffle.partitions")))


def blocks(ids: DataFrame, lengths: np.ndarray, vocabulary: int, ranges: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Documents of (doc_id, tag, n, ids) rows in ascending order, coded and packed.

    A range is a partition of the sorted rows, and its number is the partition's;
    a block never spans ranges. ``marks`` are uint32 bit offsets in a document.
    """
    spark = ids.sparkSession
    id_type = ids.schema["doc_id"].dataType.simpleString()
    dtype = np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")
    shared = spark.sparkContext.broadcast((lengths, huffman.canonical(lengths)))
    schema = (f"range int, block int, n_ids long, doc_ids array<{id_type}>, counts array<long>, "
              "places array<long>, marks binary, payload binary")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, codes = shared.value
        number = TaskContext.get().partitionId()
        held: list[tuple] = []
        block, n_ids, id_arrow = 0, 0, pa.int64()

        def flush() -> pa.RecordBatch:
            places = np.cumsum([0, *(len(h[2]) for h in held[:-1])])
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int32()), pa.array([block], pa.int32()), pa.array([n_ids], pa.int64()),
                pa.array([[h[0] for h in held]], pa.list_(id_arrow)), pa.array([[h[1] for h in held]], pa.list_(pa.int64())),
                pa.array([places], pa.list_(pa.int64())), pa.array([b"".join(h[3] for h in held)], pa.binary()),
                pa.array([b"".join(h[2] for h in held)], pa.binary())],
                ["range", "block", "n_ids", "doc_ids", "counts", "places", "marks", "payload"])

        for batch in batches:
            id_arrow = batch.column(0).type
            for a, b in _slices(_concat(batch.column(2))[1]):
                part = batch.slice(a, b - a)
                data, bounds = _concat(part.column(2))
                out, at, marks, mark_at = huffman.encode(data.view(dtype), bounds // dtype.itemsize, codes, sizes)
                raw, marks, at, mark_at = out.tobytes(), marks.astype("<u4"), at.tolist(), mark_at.tolist()
                for i, (doc_id, n) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist())):
                    if held and n_ids + n > block_ids:
                        yield flush()
                        held, block, n_ids = [], block + 1, 0
                    held.append((doc_id, n, raw[at[i]:at[i + 1]], marks[mark_at[i]:mark_at[i + 1]].tobytes()))
                    n_ids += n
        if held:
            yield flush()

    ordered = ids.repartitionByRange(ranges, "doc_id", "tag").sortWithinPartitions("doc_id", "tag")
    return ordered.select("doc_id", "n", "ids").mapInArrow(pack, schema)


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None,
                 block_ids: int = BLOCK_IDS) -> TokenFiles:
    """Write the token files of ``docs`` under ``path``; ``ranges`` follows from the ids unless given."""
    spark = docs.sparkSession
    python_tasks(spark)
    files = TokenFiles(path)
    with open(tokenizer_path or default_tokenizer_path(), encoding="utf-8") as f:
        tokenizer = f.read()
    vocabulary = Tokenizer.from_str(tokenizer).get_vocab_size()
    ids = write_ids(docs, files, tokenizer, vocabulary, end_id, id_col, text_col)
    counts = id_counts(ids, vocabulary)
    lengths = huffman.code_lengths(counts)
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").write.parquet(files.codebook)
    packed = blocks(ids, lengths, vocabulary, ranges or ranges_for(int(counts.sum()), spark), block_ids)
    packed.write.option("compression", "none").parquet(files.blocks)
    return files


def read_tokens(spark: SparkSession, files: TokenFiles, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document, from the files.

    ``ids`` are the document's ids as little-endian unsigned 32-bit integers; all
    are decoded for the checksum, without ``with_ids`` they are not returned.
    """
    python_tasks(spark)
    lengths = np.frombuffer(spark.read.parquet(files.codebook).first()[0], np.uint8)
    table = spark.sparkContext.broadcast(huffman.decode_table(lengths))
    blocks = spark.read.parquet(files.blocks)
    sums = sorted(tuple(r) for r in blocks.groupBy("range").agg(F.sum("n_ids")).collect())
    before, rows = 0, []
    for number, n in sums:
        rows.append((number, before))
        before += n
    offsets = F.broadcast(spark.createDataFrame(rows, "range int, ids_before long"))
    inside = Window.partitionBy("range").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (blocks.select("range", "block", "n_ids").join(offsets, "range")
              .select("range", "block", (F.col("ids_before") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
                      .alias("block_start")))
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _slices(_concat(batch.column(5))[1], 1 << 20):
                out = _decoded(batch.slice(a, b - a), table.value)
                yield out if with_ids else out.drop_columns(["ids"])

    # a start per block is joined to the decoded documents, not to the payloads
    documents = blocks.select("range", "block", "doc_ids", "counts", "places", "payload", "marks").mapInArrow(
        read, f"range int, block int, doc_id {id_type}, offset long, n_tokens long, ids_crc32 long"
        + ", ids binary" * with_ids)
    return (documents.join(starts, ["range", "block"])
            .select("doc_id", (F.col("block_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32",
                    *["ids"] * with_ids))


def _decoded(batch: pa.RecordBatch, table: np.ndarray) -> pa.RecordBatch:
    """The documents of some blocks, all their stretches decoded together."""
    data, byte_at = _concat(batch.column(5))
    marks = _concat(batch.column(6))[0].view("<u4").astype(np.int64)
    in_block = np.diff(batch.column(2).offsets.to_numpy())
    counts = batch.column(3).flatten().to_numpy()
    places = batch.column(4).flatten().to_numpy() + np.repeat(byte_at[:-1], in_block)
    n_marks = -(-counts // huffman.STRIDE)
    at = marks + 8 * np.repeat(places, n_marks)
    nth = np.arange(len(marks)) - np.repeat(np.cumsum(n_marks) - n_marks, n_marks)
    size = np.minimum(np.repeat(counts, n_marks) - huffman.STRIDE * nth, huffman.STRIDE)
    raw = huffman.decode(data, at, size, table).astype("<u4").tobytes()
    ends = 4 * np.cumsum(counts)
    ids = [raw[x:y] for x, y in zip((ends - 4 * counts).tolist(), ends.tolist())]
    before = np.cumsum(counts) - counts
    first = np.repeat(np.concatenate(([0], np.cumsum(in_block)[:-1])), in_block)
    return pa.RecordBatch.from_arrays([
        pa.array(np.repeat(batch.column(0).to_numpy(), in_block), pa.int32()),
        pa.array(np.repeat(batch.column(1).to_numpy(), in_block), pa.int32()),
        batch.column(2).flatten(), pa.array(before - before[first] if len(first) else before, pa.int64()),
        pa.array(counts, pa.int64()), pa.array([zlib.crc32(b) for b in ids], pa.int64()), pa.array(ids, pa.binary())],
        ["range", "block", "doc_id", "offset", "n_tokens", "ids_crc32", "ids"])


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` written as token files and read back."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    files = write_tokens(docs, scratch_path(spark, "tokens"))
    return read_tokens(spark, files, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")
