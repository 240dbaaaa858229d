"""Encoding to SentencePiece BPE ids and back, with a table of last tokens.

Merging starts from single characters and always joins the adjacent pair whose
joined piece has the best score, the leftmost first on ties. Two facts make a table
of prefixes enough to find the result:

* a token sequence is the result exactly if every token is what merging makes of
  its own text and no adjacent pair ever joins across its border;
* so every prefix of a text has one last token, whatever follows it.

An automaton over the pieces lists the tokens between any two places; of those that
end at a place, the one that is compatible with the last token before it is written
to the table, and the ids are read backwards from the end. Whether two tokens are
compatible is found by replaying the merges of both side by side
(``Merges.compatible``), once per pair that occurs.

No piece holds a space mark after another character (checked on load), so a text
is cut before each run of space marks, and of the words of a batch each distinct
one is coded once, all short ones place by place together (``tables``). Long
words, where that would not pay, go through the same table one by one, with an
Aho-Corasick automaton. Nothing but pair verdicts is kept from batch to batch.

Defined cases: a null text counts as empty and has no ids; characters the model
lacks become byte pieces (or the unknown id, if the model has none); special
strings in a text are ordinary text; rows keep their other columns, and the new
column takes a free name if one clashes; an empty table gives an empty table. A
model that is not BPE, or that has pieces of user-defined or unused type, raises
``ValueError``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimkiln.llm.common import free_name, python_tasks, read_table

SPACE = "▁"
_LONG_WORD = 48
_WORDS_AT_ONCE = 1 << 14
_PAIR_BITS = 21
_SLICE = 2 << 20


class Merges:
    """What merging does to single tokens and to pairs of them."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self._events: dict[str, list[tuple[float, str, str]]] = {}

    def merge(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """The symbols that are left of ``text``, and per merge its score and the first and last symbol after it."""
        parts, events = list(text), []
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts, events
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            events.append((best, parts[0], parts[-1]))

    def events(self, token: str) -> list[tuple[float, str, str]]:
        known = self._events.get(token)
        if known is None:
            known = self._events[token] = self.merge(token)[1]
        return known

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging ``left + right`` ends in exactly these two tokens.

        The merges of both run in order of their scores; at equal scores the left
        token's come first, then one across the border, then the right token's.
        """
        ours, theirs = self.events(left), self.events(right)
        i = j = 0
        edge, start = left[-1], right[0]
        while True:
            next_left = ours[i][0] if i < len(ours) else None
            next_right = theirs[j][0] if j < len(theirs) else None
            across = self.scores.get(edge + start)
            if (across is not None and (next_left is None or across > next_left)
                    and (next_right is None or across >= next_right)):
                return False
            if next_left is None and next_right is None:
                return True
            if next_right is None or (next_left is not None and next_left >= next_right):
                edge = ours[i][2]
                i += 1
            else:
                start = theirs[j][1]
                j += 1


class Table:
    """64-bit keys to small numbers by open addressing, looked up and filled as arrays."""

    def __init__(self, bits: int):
        self.bits = bits
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.zeros(1 << bits, np.int32)
        self.used = 0

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values of ``keys`` (none negative), -1 where there is none."""
        place, mask = self._home(keys), len(self.keys) - 1
        out = np.full(len(keys), -1, np.int32)
        todo = np.arange(len(keys))
        while len(todo):
            here = self.keys[place[todo]]
            hit = here == keys[todo]
            out[todo[hit]] = self.values[place[todo[hit]]]
            todo = todo[~hit & (here >= 0)]
            place[todo] = (place[todo] + 1) & mask
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add ``keys``, distinct and not there yet."""
        place, mask = self._home(keys), len(self.keys) - 1
        todo = np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[place[todo]] < 0]
            self.keys[place[free]] = keys[free]          # of several at one place the last one stays
            self.values[place[free]] = values[free]
            todo = todo[self.keys[place[todo]] != keys[todo]]
            place[todo] = (place[todo] + 1) & mask
        self.used += len(keys)


class PieceEncoder:
    """One model's pieces, automata and pair verdicts."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        lib = self.library
        _check_kind(lib, model)
        self.size = lib.vocab_size()
        plain = [i for i in range(self.size) if not (lib.is_unknown(i) or lib.is_control(i) or lib.is_byte(i))]
        self.piece = {i: lib.id_to_piece(i) for i in plain}
        self.scores = {self.piece[i]: lib.get_score(i) for i in plain}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.scores):
            raise ValueError("pieces with an inner space mark are not supported")
        if any(c not in self.scores for p in self.scores for c in p):
            raise ValueError("a piece holds a character that is no piece itself")
        self.merges = Merges(self.scores)
        # a piece that merging does not make of its own text never is a token
        self.tokens = {p: i for i, p in self.piece.items() if len(p) == 1 or self.merges.merge(p)[0] == [p]}
        self.unknown = lib.unk_id()
        self.bytes_id = np.array([lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.byte_fallback = all(lib.is_byte(int(i)) for i in self.bytes_id)
        self.pairs = Table(_PAIR_BITS)
        self.automaton = ahocorasick.Automaton()
        for p, i in self.tokens.items():
            self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self._build_trie()

    def _build_trie(self) -> None:
        """The pieces as a trie: edges (node, character class) -> node, and the token of each node."""
        chars = sorted({c for p in self.tokens for c in p})
        self.classes = np.zeros(0x110000, np.int32)
        self.classes[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.n_classes = len(chars) + 1
        nodes, edges, self.longest = {"": 0}, [], max(map(len, self.tokens))
        for p in sorted(self.tokens):
            for k in range(1, len(p) + 1):
                if p[:k] not in nodes:
                    nodes[p[:k]] = len(nodes)
                    edges.append((nodes[p[:k - 1]] * self.n_classes + int(self.classes[ord(p[k - 1])]), nodes[p[:k]]))
        keys, to = np.array(edges, np.int64).T
        self.edges = Table(max(4, int(len(keys)).bit_length() + 1))
        self.edges.put(keys, to.astype(np.int32))
        self.token = np.full(len(nodes), -1, np.int32)
        for p, i in self.tokens.items():
            self.token[nodes[p]] = i
        self.length = np.ones(self.size + 1, np.int64)  # the last one for characters that no token has
        for i, p in self.piece.items():
            self.length[i] = len(p)

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens is compatible."""
        keys = left.astype(np.int64) * self.size + right
        out = self.pairs.get(keys)
        missing = np.flatnonzero(out < 0)
        if len(missing):
            new = np.unique(keys[missing])
            if self.pairs.used + len(new) > len(self.pairs.keys) // 2:
                self.pairs = Table(max(_PAIR_BITS, int(len(new)).bit_length() + 2))
            verdicts = [self.merges.compatible(self.piece[k // self.size], self.piece[k % self.size]) for k in new.tolist()]
            self.pairs.put(new, np.array(verdicts, np.int32))
            out[missing] = np.array(verdicts, np.int32)[np.searchsorted(new, keys[missing])]
        return out == 1

    def last_tokens(self, text: str) -> np.ndarray:
        """Per prefix length the id of its last token; -1 where that is a character the model lacks."""
        last, verdicts = [-1] * (len(text) + 1), {}
        for end, (token, length) in self.automaton.iter(text):
            if last[end + 1] >= 0:
                continue
            before = last[end + 1 - length]
            if before >= 0:
                fits = verdicts.get((before, token))
                if fits is None:
                    fits = verdicts[before, token] = self.merges.compatible(self.piece[before], self.piece[token])
                if not fits:
                    continue
            last[end + 1] = token
        return np.array(last, np.int32)

    def matches(self, classes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, token) of all tokens in words that lie one after the other.

        ``ends`` has for every place the end of its word.
        """
        at, node = np.arange(len(classes)), np.zeros(len(classes), np.int64)
        found = []
        for k in range(self.longest):
            inside = (at + k < ends[at])
            at, node = at[inside], node[inside]
            node = self.edges.get(node * self.n_classes + classes[at + k]).astype(np.int64)
            alive = node >= 0
            at, node = at[alive], node[alive]
            if not len(at):
                break
            token = self.token[node]
            hit = token >= 0
            found.append((at[hit], at[hit] + k + 1, token[hit]))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3

    def tables(self, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The tables of last tokens of words that lie one after the other, a place more than characters each.

        All words advance together, by the place within the word.
        """
        n = np.diff(bounds)
        word = np.repeat(np.arange(len(n)), n)
        start, end, token = self.matches(self.classes[codes], np.repeat(bounds[1:], n))
        w = word[start]
        place = end - bounds[w]
        order = np.argsort(place, kind="stable")
        start, end, token, w = start[order], end[order], token[order], w[order]
        cuts = np.concatenate((np.searchsorted(place[order], np.arange(1, (int(place.max()) if len(place) else 0) + 2)), [len(place)]))
        last = np.full(len(codes) + len(n), -1, np.int32)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if a == b:
                continue
            before = last[start[a:b] + w[a:b]]
            fits = before < 0  # a word's start, or a character the model lacks
            ask = np.flatnonzero(~fits)
            fits[ask] = self.fits(before[ask], token[a:b][ask])
            last[(end[a:b] + w[a:b])[fits]] = token[a:b][fits]
        return last

    def read_back(self, last: np.ndarray, codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each word has) from the tables, read from the words' ends."""
        words = np.arange(len(bounds) - 1)
        at = bounds[1:].copy()
        steps = []
        todo = words[at > bounds[:-1]]
        while len(todo):
            token = last[at[todo] + todo]
            at[todo] -= self.length[token]
            steps.append((todo, np.where(token >= 0, token, -1 - codes[at[todo]].astype(np.int64))))
            todo = todo[at[todo] > bounds[todo]]
        count = np.zeros(len(words), np.int64)
        for todo, _ in steps:
            count[todo] += 1
        ends = np.cumsum(count)
        flat = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
        for k, (todo, token) in enumerate(steps):
            flat[ends[todo] - 1 - k] = token
        return self._bytes_for_unknown(flat, count)

    def _bytes_for_unknown(self, flat: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters the model lacks, held as -1 - code point, as byte pieces or the unknown id."""
        missing = flat < 0
        if not missing.any():
            return flat.astype(np.int32), count
        word = np.repeat(np.arange(len(count)), count)
        if not self.byte_fallback:  # neighbours share one unknown id
            again = missing & np.concatenate(([False], missing[:-1] & (word[1:] == word[:-1])))
            out = np.where(missing, self.unknown, flat)[~again].astype(np.int32)
            return out, np.bincount(word[~again], minlength=len(count))
        code = -1 - flat
        size = np.where(missing, 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF), 1)
        first = np.cumsum(size) - size
        out = np.repeat(flat, size)
        nth = np.arange(len(out)) - np.repeat(first, size)
        code, size_of = np.repeat(code, size), np.repeat(size, size)
        tail = 0x80 | (code >> np.maximum(6 * (size_of - 1 - nth), 0)) & 0x3F
        lead = np.select([size_of == 1, size_of == 2, size_of == 3], [code, 0xC0 | code >> 6, 0xE0 | code >> 12], 0xF0 | code >> 18)
        at = np.flatnonzero(out < 0)
        out[at] = self.bytes_id[np.where(nth == 0, lead, tail)[at]]
        return out.astype(np.int32), np.bincount(word, weights=size, minlength=len(count)).astype(np.int64)

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all distinct ``words`` one after the other, how many each has)."""
        length = pc.utf8_length(words).to_numpy().astype(np.int64)
        long = np.flatnonzero(length > _LONG_WORD)
        if len(long):
            return self._with_long(words, length, long)
        ids, counts = [], []
        for a in range(0, len(words), _WORDS_AT_ONCE):
            part = words.slice(a, _WORDS_AT_ONCE)
            codes = np.frombuffer(_joined(part).encode("utf-32-le"), "<u4").astype(np.int64)
            bounds = np.concatenate(([0], np.cumsum(length[a:a + _WORDS_AT_ONCE])))
            i, c = self.read_back(self.tables(codes, bounds), codes, bounds)
            ids.append(i)
            counts.append(c)
        return (np.concatenate(ids), np.concatenate(counts)) if ids else (np.zeros(0, np.int32), np.zeros(0, np.int64))

    def _with_long(self, words: pa.Array, length: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = self.encode_words(words.filter(pa.array(length <= _LONG_WORD)))
        cuts = np.cumsum(counts)
        out, per, last, seen = [], np.zeros(len(words), np.int64), 0, 0
        per[length <= _LONG_WORD] = counts
        for k, i in enumerate(long.tolist()):
            w = words[i].as_py()
            codes = np.frombuffer(w.encode("utf-32-le"), "<u4").astype(np.int64)
            made = self.read_back(self.last_tokens(w), codes, np.array([0, len(w)]))[0]
            seen = int(cuts[i - k - 1]) if i > k else 0  # ids of the short words before it
            out += [ids[last:seen], made]
            last, per[i] = seen, len(made)
        return np.concatenate([*out, ids[last:]]), per

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all whole texts one after the other, how many each has)."""
        parts = [self._encode_slice(texts.slice(a, b - a)) for a, b in _slices(texts)]
        return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int32), np.zeros(0, np.int64))

    def _encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        n = len(texts)
        full = pc.greater(pc.binary_length(texts), 0)
        none, space = pa.scalar("", pa.large_string()), pa.scalar(SPACE, pa.large_string())
        marked = pc.if_else(full, pc.binary_join_element_wise(none, pc.replace_substring(texts, " ", SPACE), space), none)
        data = np.frombuffer(marked.buffers()[2] or b"", np.uint8)
        bounds = np.frombuffer(marked.buffers()[1], np.int64)[marked.offset:marked.offset + n + 1]
        data, bounds = data[bounds[0]:bounds[-1]], bounds - bounds[0]
        mark = np.frombuffer(SPACE.encode(), np.uint8)
        at = np.flatnonzero((data[:-2] == mark[0]) & (data[1:-1] == mark[1]) & (data[2:] == mark[2])) if len(data) > 2 else np.zeros(0, np.int64)
        # a word starts with its text and at each space mark that follows something else
        first = np.unique(np.concatenate((bounds[:-1][np.diff(bounds) > 0], at[np.diff(at, prepend=-9) != len(mark)])))
        cuts = np.append(first, len(data)).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(cuts), pa.py_buffer(
            np.ascontiguousarray(data))]).dictionary_encode()
        ids, count = self.encode_words(words.dictionary)
        ends = np.concatenate(([0], np.cumsum(count))) * 4
        coded = pa.Array.from_buffers(pa.large_binary(), len(count), [None, pa.py_buffer(ends), pa.py_buffer(ids)])
        taken = coded.take(words.indices)
        upto = np.frombuffer(taken.buffers()[1], np.int64)[:len(first) + 1] // 4
        flat = np.frombuffer(taken.buffers()[2] or b"", np.int32)[:upto[-1]]
        size = np.diff(upto)
        text = np.searchsorted(bounds, first, side="right") - 1
        return flat, np.bincount(text, weights=size, minlength=n).astype(np.int64)

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text."""
        return self.encode_batch(pa.array([text], pa.large_string()))[0].tolist()


def _joined(words: pa.Array) -> str:
    """The text of a large string array, its values one after the other."""
    bounds = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    return words.buffers()[2][int(bounds[0]):int(bounds[-1])].to_pybytes().decode() if len(words) else ""


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``_SLICE`` bytes each, so that work arrays stay small."""
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    at, n = 0, len(texts)
    while at < n:
        last = max(int(np.searchsorted(bounds, bounds[at] + _SLICE, side="right")) - 1, at + 1)
        yield at, last
        at = last


def _check_kind(lib: sentencepiece.SentencePieceProcessor, model: bytes) -> None:
    from sentencepiece import sentencepiece_model_pb2 as pb

    spec = pb.ModelProto()
    spec.ParseFromString(model)
    rule = spec.normalizer_spec
    if spec.trainer_spec.model_type != pb.TrainerSpec.BPE or spec.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only BPE models with leading space marks are supported")
    if (rule.precompiled_charsmap or rule.remove_extra_whitespaces or not rule.add_dummy_prefix
            or not rule.escape_whitespaces):
        raise ValueError("only models that leave texts as they are, with a leading space mark, are supported")
    kinds = pb.ModelProto.SentencePiece
    if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in spec.pieces):
        raise ValueError("user-defined and unused pieces are not supported")


def default_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


_ENCODERS: dict[int, PieceEncoder] = {}


def _encoder(model: bytes) -> PieceEncoder:
    """One encoder per worker process; its pair verdicts outlive a task."""
    key = hash(model)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(model)
    return _ENCODERS[key]


_LIBRARIES: dict[int, sentencepiece.SentencePieceProcessor] = {}


def _library(model: bytes) -> sentencepiece.SentencePieceProcessor:
    key = hash(model)
    if key not in _LIBRARIES:
        _LIBRARIES[key] = sentencepiece.SentencePieceProcessor(model_proto=model)
    return _LIBRARIES[key]


def _model(model_path: str | None) -> bytes:
    with open(model_path or default_model_path(), "rb") as f:
        return f.read()


def encode_pieces(docs: DataFrame, model_path: str | None = None, text_col: str = "text",
                  ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """``docs`` with an array<int> column of ids (``ids_col``, or a free name like it).

    With ``decoded_col`` the ids are decoded in the same pass (as ``decode_pieces``
    would in another), into a column of that name or a free one like it.
    """
    spark = docs.sparkSession
    python_tasks(spark)
    shared = spark.sparkContext.broadcast(_model(model_path))  # one model file
    name = free_name(docs, ids_col)
    fields = [*docs.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))]
    if decoded_col is not None:
        fields.append(T.StructField(free_name(docs, decoded_col), T.StringType()))
    names = [f.name for f in fields]
    at = docs.columns.index(text_col)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            texts = pc.fill_null(batch.column(at), "").cast(pa.large_string())
            for a, b in _slices(texts):
                ids, count = encoder.encode_batch(texts.slice(a, b - a))
                ends = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
                made = [pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))]
                if decoded_col is not None:
                    made.append(_decoded(encoder.library, made[0]))
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), *made], names)

    return docs.mapInArrow(encode, T.StructType(fields))


def _decoded(library: sentencepiece.SentencePieceProcessor, listed: pa.ListArray) -> pa.Array:
    """The library's text of each list of ids; one text's ids at a time become Python numbers."""
    values, ends = listed.values.to_numpy(zero_copy_only=False), listed.offsets.to_numpy().tolist()
    return pa.array([library.decode(values[a:b].tolist()) if b > a and listed[i].is_valid else ""
                     for i, (a, b) in enumerate(zip(ends[:-1], ends[1:]))], pa.string())


def decode_pieces(rows: DataFrame, model_path: str | None = None, ids_col: str = "ids",
                  text_col: str = "decoded") -> DataFrame:
    """``rows`` with the library's text of their ids (``text_col``, or a free name like it); null ids count as none."""
    spark = rows.sparkSession
    python_tasks(spark)
    shared = spark.sparkContext.broadcast(_model(model_path))
    name = free_name(rows, text_col)
    at = rows.columns.index(ids_col)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _library(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, _decoded(library, batch.column(at))],
                                             [*batch.schema.names, name])

    return rows.mapInArrow(decode, T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())]))


def op11_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` encoded to piece ids and decoded again."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_pieces(docs, decoded_col="decoded").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
