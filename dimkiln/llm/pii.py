"""Personal data by bootstrapped contextual extraction (native).

Strict forms (e-mail, IP address, card number, phone number) always count and are
the seeds. The words next to seeds, and the labels glued to their front (``tel:``,
``mail=<``), are lexical patterns: (kind, side, word). A
pattern's instances are the seeds and the loosely formed identifiers of its kind
that stand next to its word anywhere in the corpus; pattern and instance tables
form a graph whose edges carry occurrence counts. Scores and confidences are the
least solution of

* a pattern's confidence is the score-weighted share of its instances among
  *all* occurrences of its word in the corpus;
* a loose instance's score is the noisy-or of the confidences of its patterns,

found in rounds until they settle. A round solves each pattern's own loop (it
scores instances that score it) at once: with ``all`` occurrences beside
instances, ``open`` the part of them that no other pattern vouches for, and
``total``, the confidence is (all - open) / (total - open). So beside a word with
seeds, loose instances count neither for nor against it; other things do.

Loose identifiers next to a pattern of high confidence are found personal data.
A word that mostly stands next to other things never becomes such a pattern, so
in text without telling contexts nothing is added.

All of it is Spark expressions: matches are taken with ``regexp_extract_all`` and
their places with ``split`` by the same expression. The expressions hold
possessive quantifiers and may start a match only where a run of its first
characters starts or where the last match ended; both leave the leftmost matches
as they are and keep time and stack bounded on very long texts.

Defined cases: a null text counts as empty; repeated rows and null ids are each
returned; found spans never overlap strict ones or each other (the earlier kind,
then the earlier start stays); an empty table gives an empty result; other
columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkiln.llm.common import materialise, read_table, text_of

KINDS = ("email", "ip", "card", "phone")
STRICT = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++\x20?(?:@|\[at\]|\(at\))\x20?[A-Za-z0-9-]++"
             r"(?:\x20?(?:\.|\[dot\]|\(dot\))\x20?[A-Za-z0-9-]++)*+",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:[.:-][0-9]++){3}",
    "card": STRICT["card"],
    "phone": r"\(?[0-9][\x20().0-9-]+[0-9]",
}
# a text without this cannot match either form of the kind
HINT = {"email": r"@|\[at\]|\(at\)", "ip": r"[0-9][.:-][0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"[0-9]"}
# letters and digits, then marks, at the start of a word
LABEL = r"[A-Za-z0-9]*+[:=<>\"'|/;#\[{]++"
CONTEXT = 64
MIN_SUPPORT = 3
HIGH = 0.8
SETTLED = 1e-6  # a round that changes no confidence by more than this part of it is the last
BROADCAST_WORDS, BROADCAST_LENGTH = 200_000, 64
SPAN = "array<struct<start:int,end:int,value:string>>"


def spans(text: Column, regex: str) -> Column:
    """(start, end, value) of the leftmost matches, in code points, end exclusive."""
    values = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    between = F.split(text, regex, -1)
    return F.aggregate(
        F.arrays_zip(F.slice(between, 1, F.size(values)).alias("gap"), values.alias("value")),
        F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out")),
        lambda a, m: F.struct(
            (a["at"] + F.length(m["gap"]) + F.length(m["value"])).alias("at"),
            F.concat(a["out"], F.array(F.struct(
                (a["at"] + F.length(m["gap"])).alias("start"),
                (a["at"] + F.length(m["gap"]) + F.length(m["value"])).alias("end"),
                m["value"].alias("value")))).alias("out")),
        lambda a: a["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The Luhn check of a string of digits."""
    back = F.reverse(digits)

    def part(i: Column) -> Column:
        d = back.substr(i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + part(i))
    return total % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """The strict check of a match."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (p.cast("int") <= 255))
    digits = _digits(value)
    if kind == "card":
        return F.length(digits).between(13, 19) & luhn(digits)
    return F.length(digits).between(9, 15)


def plausible(kind: str, value: Column) -> Column:
    """What a loose match must have."""
    digits = F.length(_digits(value))
    return {"email": F.lit(True), "ip": digits <= 16, "card": digits.between(12, 19),
            "phone": digits.between(7, 15)}[kind]


def _found(text: Column, kind: str, regex: str, check) -> Column:
    matches = F.filter(spans(text, regex), lambda m: check(kind, m["value"]))
    return F.when(text.rlike(HINT[kind]), matches).otherwise(F.array().cast(SPAN))


def _neighbours(text: Column, m: Column) -> tuple[Column, Column, Column]:
    """The words before and after a span, lower-cased, whole and beyond any white space,
    and the label glued to its front.

    Empty at the text's ends; a word is empty where no white space stands between.
    They are looked for within ``CONTEXT`` characters first; where that window may
    cut one, the whole text on that side is used.
    """
    before, after = r"(\S++)\s++$", r"^\s++(\S++)"
    label = r"(?:^|(?<=\s))(" + LABEL + r")$"
    left = text.substr(F.greatest(m["start"] - CONTEXT + 1, F.lit(1)), F.least(m["start"], F.lit(CONTEXT)))
    right = text.substr(m["end"] + 1, F.lit(CONTEXT))
    cut_left = (m["start"] > CONTEXT) & left.rlike(r"^\S*+\s++$")
    cut_right = (F.length(right) == CONTEXT) & right.rlike(r"^\s++\S*+$")
    return (F.lower(F.when(cut_left, F.regexp_extract(text.substr(F.lit(1), m["start"]), before, 1))
                    .otherwise(F.regexp_extract(left, before, 1))),
            F.lower(F.when(cut_right, F.regexp_extract(text.substr(m["end"] + 1, F.length(text)), after, 1))
                    .otherwise(F.regexp_extract(right, after, 1))),
            F.lower(F.when((m["start"] > CONTEXT) & left.rlike(r"^\S++$"),
                           F.regexp_extract(text.substr(F.lit(1), m["start"]), label, 1))
                    .otherwise(F.when(m["start"] > 0, F.regexp_extract(left, label, 1)).otherwise(""))))


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, kind columns, seen): strict spans per kind, and every strict or loose
    occurrence with its neighbours, for each text; written once, without the texts."""
    text = F.col("text")
    base = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).withColumns(
        {k: _found(text, k, STRICT[k], valid) for k in KINDS})
    strict = F.concat(*[F.col(k) for k in KINDS])

    def occurrences(kind: str, found: Column, seed: bool) -> Column:
        return F.transform(found, lambda m: F.struct(
            F.lit(kind).alias("kind"), F.lit(seed).alias("seed"), m["start"].alias("start"), m["end"].alias("end"),
            F.lower(m["value"]).alias("value"), _neighbours(text, m)[0].alias("before"),
            _neighbours(text, m)[1].alias("after"), _neighbours(text, m)[2].alias("label")))

    seen = []
    for kind in KINDS:
        loose = F.filter(_found(text, kind, LOOSE[kind], plausible),
                         lambda m: ~F.exists(F.col("strict"), lambda s: _overlaps(m, s)))
        seen += [occurrences(kind, F.col(kind), True), occurrences(kind, loose, False)]
    return materialise(
        base.withColumn("strict", strict).withColumn("seen", F.concat(*seen))
        .select("id", F.monotonically_increasing_id().alias("row"), *KINDS, "seen"), "pii-scan")


def edges(scanned: DataFrame) -> DataFrame:
    """(kind, side, word, value, seed, n): how often an instance stands next to a word."""
    seen = scanned.select(F.inline("seen"))
    sides = F.array(F.struct(F.lit("before").alias("side"), F.col("before").alias("word")),
                    F.struct(F.lit("after").alias("side"), F.col("after").alias("word")),
                    F.struct(F.lit("label").alias("side"), F.col("label").alias("word")))
    return (seen.select("kind", "value", "seed", F.inline(sides)).filter(F.col("word") != "")
            .groupBy("kind", "side", "word", "value").agg(F.max("seed").alias("seed"), F.count(F.lit(1)).alias("n")))


def word_totals(docs: DataFrame, words: DataFrame, text_col: str = "text") -> DataFrame:
    """(glued, word, total): occurrences over all texts of the (glued, word) rows of ``words``.

    A label occurs in front of the rest of each word that starts with it. Few and
    short words are broadcast and filter the corpus's words before they are counted;
    otherwise they are joined to the counts.
    """
    tokens = docs.select(F.explode(F.split(F.lower(text_of(text_col)), r"\s+")).alias("word"))
    tokens = tokens.select(F.lit(False).alias("glued"), "word")
    n, longest, labels = words.agg(F.count(F.lit(1)), F.max(F.length("word")), F.count_if("glued")).first()
    if labels:
        label = F.regexp_extract("word", "^(" + LABEL + r")(?=\S)", 1).alias("word")
        tokens = tokens.union(tokens.select(F.lit(True), label).filter("word <> ''"))
    pair = ["glued", "word"]
    if n <= BROADCAST_WORDS and (longest or 0) <= BROADCAST_LENGTH:
        return tokens.join(F.broadcast(words), pair, "left_semi").groupBy(*pair).agg(F.count(F.lit(1)).alias("total"))
    return tokens.groupBy(*pair).agg(F.count(F.lit(1)).alias("total")).join(words, pair, "left_semi")


def confident_patterns(docs: DataFrame, scanned: DataFrame, text_col: str = "text",
                       min_support: int = MIN_SUPPORT, high: float = HIGH) -> DataFrame:
    """(kind, side, word, confidence) of the patterns that discover instances.

    A pattern needs ``min_support`` different seeds. Confidences only grow from
    round to round and stay below the share of all instances (``top``), so the
    rounds also end when no pattern is left that could still become confident.
    """
    pattern = ["kind", "side", "word"]
    graph = materialise(edges(scanned), "pii-edges")
    able = materialise(graph.groupBy(*pattern).agg(
        F.count(F.when(F.col("seed"), 1)).alias("seeds"), F.sum("n").alias("n_all"))
        .filter(F.col("seeds") >= min_support), "pii-patterns")
    able = able.withColumn("glued", F.col("side") == "label")
    totals = word_totals(docs, materialise(able.select("glued", "word").distinct(), "pii-words"), text_col)
    confidence = materialise(
        able.join(totals, ["glued", "word"], "left")
        .select(*pattern, "n_all", F.greatest(F.coalesce("total", F.lit(0)), "n_all").alias("total"),
                F.lit(0.0).alias("confidence")), "pii-able")
    top = F.col("n_all") / F.col("total")
    sure = F.round("confidence", 9) >= high
    waiting = F.count(F.when((F.round(top, 9) >= high) & ~sure, 1))
    change = F.max((F.col("confidence") - F.col("earlier")) / F.col("confidence"))
    if confidence.agg(waiting).first()[0]:
        graph = materialise(graph.join(confidence.select(*pattern), pattern), "pii-graph")
        left, moved = 1, 1.0
        while left and moved > SETTLED:
            confidence = materialise(_round(graph, confidence), "pii-confidence")
            left, moved = confidence.agg(waiting, change).first()
    return confidence.filter(sure).select(*pattern, "confidence")


def _round(graph: DataFrame, confidence: DataFrame) -> DataFrame:
    """``confidence`` after one more round, with the one before as ``earlier``."""
    pattern = ["kind", "side", "word"]
    doubt = F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-12)))
    scored = graph.join(confidence.select(*pattern, doubt.alias("doubt")), pattern)
    instances = scored.groupBy("kind", "value").agg(F.max("seed").alias("known"), F.sum("doubt").alias("doubts"))
    # what the instance's other patterns leave open
    rest = F.when(F.col("known"), 0.0).otherwise(F.exp(F.least(F.col("doubts") - F.col("doubt"), F.lit(0.0))))
    opened = (scored.join(instances, ["kind", "value"]).groupBy(*pattern)
              .agg(F.sum(F.col("n") * rest).alias("open")))
    now = (F.col("n_all") - F.col("open")) / (F.col("total") - F.col("open"))
    return (confidence.join(opened, pattern)
            .select(*pattern, "n_all", "total", F.col("confidence").alias("earlier"),
                    F.greatest(now, "confidence").alias("confidence")))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, email, ip, card, phone, found): strict spans by kind, and ``found`` with the
    (kind, start, end) of what the patterns added."""
    scanned = scan(docs, id_col, text_col)
    patterns = confident_patterns(docs, scanned, text_col).select("kind", "side", "word")
    loose = scanned.select("row", F.inline("seen")).filter(~F.col("seed"))
    hits = None
    for side in ("before", "after", "label"):
        own = patterns.filter(F.col("side") == side).select("kind", F.col("word").alias(side))
        part = loose.join(own, ["kind", side], "left_semi").select("row", "kind", "start", "end")
        hits = part if hits is None else hits.union(part)
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    spans_of = F.sort_array(F.collect_set(F.struct(rank.alias("rank"), "start", "end", "kind")))
    apart = F.aggregate(
        "all", F.array().cast("array<struct<kind:string,start:int,end:int>>"),
        lambda out, m: F.when(F.exists(out, lambda o: _overlaps(o, m)), out).otherwise(F.concat(out, F.array(
            F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end"))))))
    found = materialise(hits.groupBy("row").agg(spans_of.alias("all")).select("row", apart.alias("found")), "pii-found")
    return (scanned.select("row", "id", *KINDS).join(found, "row", "left")
            .withColumn("found", F.coalesce("found", F.array().cast("array<struct<kind:string,start:int,end:int>>")))
            .drop("row"))


def _listed(columns: list[Column]) -> Column:
    return F.array_join(F.flatten(F.array(*columns)), ",")


def _named(kind: str, found: Column) -> Column:
    return F.transform(found, lambda m: F.concat_ws(":", F.lit(kind), m["start"].cast("string"), m["end"].cast("string")))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every row of ``documents``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal_data(docs)

    def merged(kind: str) -> Column:
        place = lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"))
        added = F.filter("found", lambda m: m["kind"] == kind)
        return F.sort_array(F.concat(F.transform(F.col(kind), place), F.transform(added, place)))

    return found.select(
        F.col("id").alias("doc_id"), *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_listed([_named(k, F.col(k)) for k in KINDS]).cast("binary"), 256).alias("base_sha256"),
        _listed([_named(k, merged(k)) for k in KINDS]).alias("spans"))
