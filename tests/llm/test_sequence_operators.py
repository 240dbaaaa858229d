"""Piece ids, phrases and prefix tries: the library, brute force, awkward rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as pb

from dimkiln.llm import collocations, piece_codec, prefix_trie

SF = "/root/testdata/sf0.001"


# --- pieces ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoder():
    return piece_codec.PieceEncoder(piece_codec._model(None))


def ids_of(encoder, text):
    return encoder.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="abeinrst ▁.,\n\tßé𝕊", max_size=80),
                 st.text(alphabet=" ▁", max_size=70)))
def test_ids_are_the_library_s(encoder, text):
    assert ids_of(encoder, text) == encoder.library.encode(text)


def test_pieces_joined_at_random(encoder):
    rng, pieces = random.Random(5), list(encoder.scores)
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 7)))
        assert ids_of(encoder, text) == encoder.library.encode(text)


def toy_model(rng, fallback=False):
    """A BPE model of few pieces with scores in any order and ties; nothing is trained."""
    model = pb.ModelProto()
    kind = pb.ModelProto.SentencePiece
    for piece, t in (("<unk>", kind.UNKNOWN), ("<s>", kind.CONTROL), ("</s>", kind.CONTROL)):
        model.pieces.add(piece=piece, score=0, type=t)
    chars = list("abc▁")
    made = set(chars)
    for _ in range(rng.randint(3, 25)):
        a, b = rng.choice(sorted(made)), rng.choice(sorted(made))
        if len(a + b) <= 6 and "▁" not in (a + b).lstrip("▁"):
            made.add(a + b)
    for piece in sorted(made):
        model.pieces.add(piece=piece, score=-100 if piece in chars else -rng.randint(1, 12), type=kind.NORMAL)
    model.trainer_spec.model_type = pb.TrainerSpec.BPE
    model.trainer_spec.unk_id, model.trainer_spec.bos_id, model.trainer_spec.eos_id = 0, 1, 2
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = True
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = True
    return model


def test_models_with_ties_unreachable_pieces_and_unknown_characters():
    rng = random.Random(11)
    for _ in range(60):
        encoder = piece_codec.PieceEncoder(toy_model(rng).SerializeToString())
        for _ in range(60):
            text = "".join(rng.choice("aabbc xyc  ") for _ in range(rng.randint(0, 25)))
            assert ids_of(encoder, text) == encoder.library.encode(text)


def test_pairs_fit_exactly_if_merging_both_leaves_both():
    rng = random.Random(3)
    for _ in range(40):
        scores = {p.piece: p.score for p in toy_model(rng).pieces if p.type == 1}
        merges = piece_codec.Merges(scores)
        whole = [p for p in scores if merges.merge(p)[0] == [p]]
        for a in whole:
            for b in whole:
                assert merges.compatible(a, b) == (merges.merge(a + b)[0] == [a, b])


@pytest.mark.parametrize("change", [
    lambda m: setattr(m.trainer_spec, "model_type", pb.TrainerSpec.UNIGRAM),
    lambda m: setattr(m.normalizer_spec, "remove_extra_whitespaces", True),
    lambda m: m.pieces.add(piece="ab", score=0, type=pb.ModelProto.SentencePiece.USER_DEFINED),
    lambda m: m.pieces.add(piece="a▁", score=-3, type=pb.ModelProto.SentencePiece.NORMAL),
    lambda m: m.pieces.add(piece="aq", score=-3, type=pb.ModelProto.SentencePiece.NORMAL)])
def test_other_models_are_refused(change):
    model = toy_model(random.Random(1))
    kept = [p for p in model.pieces if p.piece not in ("ab", "a▁")]
    del model.pieces[:]
    model.pieces.extend(kept)
    change(model)
    with pytest.raises((ValueError, RuntimeError)):
        piece_codec.PieceEncoder(model.SerializeToString())


def test_piece_query(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=piece_codec.default_model_path())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode(r.text or "")
        want[r.doc_id] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    got = {r.doc_id: tuple(r)[1:] for r in piece_codec.op11_piece_codec(spark, SF).collect()}
    assert got == want


def test_awkward_texts_to_pieces_and_back(spark):
    texts = [None, "", " ", "▁", "a" * 3000, "\x00", "<s></s><unk><0x41>", "word " * 20000, "é𝕊" * 50, "same", "same"]
    df = spark.createDataFrame([(None if i == 3 else i % 4, t, "kept", "x") for i, t in enumerate(texts)],
                               "doc_id long, text string, ids string, Decoded string")
    encoded = piece_codec.encode_pieces(df)
    assert encoded.columns == [*df.columns, "ids_"]
    back = piece_codec.decode_pieces(encoded, ids_col="ids_")
    assert back.columns[-1] == "decoded_"
    rows = back.collect()
    library = sentencepiece.SentencePieceProcessor(model_file=piece_codec.default_model_path())
    assert Counter((r.text, tuple(r.ids_), r.decoded_) for r in rows) == Counter(
        (t, tuple(library.encode(t or "")), library.decode(library.encode(t or "")) if t else "") for t in texts)
    both = piece_codec.encode_pieces(df, decoded_col="decoded")
    assert both.columns == back.columns and Counter(map(str, both.collect())) == Counter(map(str, rows))
    none = df.filter("false")
    assert piece_codec.decode_pieces(piece_codec.encode_pieces(none), ids_col="ids_").count() == 0
    nulls = encoded.withColumn("ids_", F.lit(None).cast("array<int>"))
    assert {r.decoded_ for r in piece_codec.decode_pieces(nulls, ids_col="ids_").collect()} == {""}


# --- phrases ---------------------------------------------------------------------------


def phrases_by_hand(rows, least, top):
    counts, totals = defaultdict(Counter), Counter()
    ends, lower = set(".,;:!?\x0a\x0b\x0c\x0d"), {c: chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        pieces, now = [], ""
        for c in text or "":
            if c in ends:
                pieces.append(now)
                now = ""
            else:
                now += lower.get(c, c)
        for piece in [*pieces, now]:
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            totals[lang] += len(words)
            for k in range(1, 6):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, seen in counts.items():
        rows = []
        for phrase, a in seen.items():
            if len(phrase) < 2 or a < least:
                continue
            cuts = [(1000 * a * totals[lang] // (seen[phrase[:k]] * seen[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            inside = any(len(p) > len(phrase) and f >= a and f >= least and any(
                p[i:i + len(phrase)] == phrase for i in range(len(p) - len(phrase) + 1)) for p, f in seen.items())
            if not inside:
                rows.append((-score, -a, " ".join(phrase).encode(), seen[phrase[:k]], seen[phrase[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, totals[lang], -s)
                for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("hash_bits,map_bits", [(13, 13), (16, 13), (34, 27)])
def test_phrases_by_hand(spark, hash_bits, map_bits):
    rng = random.Random(hash_bits)
    words = ["a", "B", "b", "c", "Ü", "ü", "d e", "x-y"]
    rows = [(rng.choice(["en", "de", None, "und"]), "".join(
        rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ", "]) for _ in range(rng.randint(0, 60))))
        for _ in range(60)] + [(None, None), ("en", ""), ("en", " .,;"), ("xx", "one"), ("yy", "t t t t t t t t")] * 2
    df = spark.createDataFrame([(l, t, 1, "w") for l, t in rows], "lang string, text string, n int, w1 string")
    got = sorted(tuple(r) for r in collocations.collocations(df, least=4, top=40, hash_bits=hash_bits, map_bits=map_bits).collect())
    assert got == phrases_by_hand(rows, 4, 40) and any(r[0] == "yy" for r in got)


def test_no_phrases(spark):
    df = spark.createDataFrame([("en", "a b a b")], "lang string, text string")
    assert collocations.collocations(df).count() == 0
    assert collocations.collocations(df.filter("false")).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    n, a, l, r = 9_000_000_000_000_017, 3_000_000_000_000_001, 3_000_000_000_000_007, 4_000_000_000_000_003
    df = spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long")
    assert df.select(collocations._score().alias("s")).first().s == 1000 * a * n // (l * r)


def test_one_word_that_is_everywhere(spark):
    df = spark.createDataFrame([("en", "hot " * 4000), ("en", "hot cold " * 300)], "lang string, text string")
    got = sorted(tuple(r) for r in collocations.collocations(df).collect())
    assert got == phrases_by_hand([tuple(r) for r in df.collect()], 100, 2000)


# --- tries -----------------------------------------------------------------------------


def crc(conv):
    return zlib.crc32(str(conv).encode()) % 9


def rebuilt_by_hand(rows):
    """Sequences of (role, text) per conversation, each on its neighbour's opening."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            turns[conv].append(((turn is not None, turn or 0), digest, (role, text)))
    plain = {c: [t for *_, t in sorted(ts)] for c, ts in turns.items()}
    return plain, {c: plain.get(c - c % 5, [])[:crc(c)] + plain[c][crc(c):] for c in plain}


def nodes_by_hand(seqs):
    members = defaultdict(list)
    for conv, seq in seqs.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(conv)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids[path]
            saved[path[:d]] += (len(convs) - 1) * (len(path[-1][1].encode()) if path else 0)
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(seqs[c]) == len(path))
        out.append((min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), kids[path],
                    leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "kept", 1) for r in rows],
                                 "conv_id long, turn long, role string, text string, depth string, size int")


def random_rows(rng, n):
    rows = []
    for conv in rng.sample(range(-20, 5 * n), n):
        for turn in range(rng.randint(1, 7)):
            rows.append((conv, rng.choice([turn, turn, None]), rng.choice(["user", "bot", None]),
                         rng.choice(["", None, "a", "é", "long text"])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [1, 6, 10_000])
def test_trie_by_hand(spark, limit):
    rng = random.Random(limit)
    rows = random_rows(rng, 30) + [(None, 1, "user", "lost"), (7001, 1, "user", "x"), (7001, 1, "user", "x"),
                                   (7002, 1, "user", "x" * 70000)]
    plain, _ = rebuilt_by_hand(rows)
    assert rows_of(prefix_trie.conversation_trie(conversations(spark, rows), limit)) == nodes_by_hand(plain)


def test_openings_by_hand(spark):
    rows = random_rows(random.Random(9), 80)
    turns, ids = prefix_trie.shared_openings(prefix_trie.turn_rows(conversations(spark, rows)))
    got = rows_of(prefix_trie.trie(prefix_trie.sequences(turns, ids), 5))
    want = nodes_by_hand(rebuilt_by_hand(rows)[1])
    assert got == want and any(r[1] == 0 for r in got)


def test_many_copies_and_a_chain_of_prefixes(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(9000) for t in range(2)]
    rows += [(20000 + c, t, "user", f"step {t}") for c in range(14) for t in range(c + 1)]
    plain, _ = rebuilt_by_hand(rows)
    assert rows_of(prefix_trie.conversation_trie(conversations(spark, rows), 8)) == nodes_by_hand(plain)


def test_trie_of_nothing(spark):
    assert prefix_trie.conversation_trie(conversations(spark, [(1, 1, "a", "b")]).filter("false")).count() == 0
    assert prefix_trie.conversation_trie(conversations(spark, [(None, 1, "a", "b")])).count() == 0
