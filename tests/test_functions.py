"""Scalar functions: text clean-up, flags, reasons, declared types (P-01..P-17)."""

import re

import pytest
from pyspark.sql import functions as F

from dimkiln.functions import flags, text, types
from dimkiln.spec import flag_value, qualify, sk_column_for


def _one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


@pytest.mark.parametrize("raw, want", [
    ("a\nb", "a b"), ("a\r\n\tb", "a b"), ("a\\b", "a b"), ("  a   b  ", "a b"),
    ("a  b", "a b"), ("a\x1cb", "a b"), ("\\ a \\", "a"), ("", ""), (None, None),
])
def test_sanitize_matches_python_rule(spark, raw, want):
    assert _one(spark, text.sanitize("v"), raw) == want
    if raw is not None:  # the reference rule in plain Python
        py = re.sub(r"\s+", " ", re.sub(r"[\n\r\t\\]", " ", raw).strip()).strip()
        assert py == want


def test_sanitize_equals_regex_form_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    regex = F.trim(F.regexp_replace("text", text.SANITIZE_PATTERN, " "))
    assert docs.filter(text.sanitize("text") != regex).count() == 0


def test_whitespace_class_is_python_whitespace():
    chars = text.WHITESPACE_CHARS
    assert all(c.isspace() for c in chars)
    assert "\xa0" in chars and "\x1c" in chars and "　" in chars
    assert len(chars) == sum(1 for c in range(0x10000) if chr(c).isspace())


@pytest.mark.parametrize("raw, want", [("  x y\n", "x y"), ("\tz", "z"), ("", "")])
def test_strip_ws(spark, raw, want):
    assert _one(spark, text.strip_ws("v"), raw) == want


@pytest.mark.parametrize("raw, want", [
    ("1", True), (" 1 ", True), ("1.0", True), ("0", False), ("", False), (None, False),
    ("True", False), ("2", False), ("abc", False)])
def test_parse_flag(spark, raw, want):
    assert _one(spark, flags.parse_flag("v"), raw) is want
    assert flag_value(raw) is want


def test_flag_value_python_types():
    assert flag_value(1) and flag_value(1.0) and flag_value(True) and not flag_value(0)


def test_duplicate_reason(spark):
    df = spark.createDataFrame([("P1", None)], "Place_Code string, Zone string")
    r = df.select(text.duplicate_reason(["Place_Code", "Zone"]).alias("r")).first()["r"]
    assert r == "DUPLICATE_RECORD: PK Place_Code=P1, Zone=NULL"


def test_prefixed_reason_and_last_line(spark):
    long = "  " + "x" * 300 + "\n"
    r = _one(spark, text.prefixed_reason(text.BULK_PREFIX, F.col("v")), long)
    assert r == "BCP_REJECTED: " + "x" * 200
    assert _one(spark, text.last_line("v"), "a\nb\nlast one") == "last one"


def test_row_json_keeps_nulls(spark):
    df = spark.createDataFrame([("é", None)], "a string, b string")
    assert df.select(text.row_json(["a", "b"]).alias("j")).first()["j"] == '{"a":"é","b":null}'


def test_key_renames_only_keys():
    assert text.key_renames(["Place code", "Place Name"], ["Place_code"]) == {"Place code": "Place_code"}


def test_declared_types():
    assert types.parse_declared("VARCHAR(50)").max_length == 50
    assert types.parse_declared("nvarchar(max)").max_length is None
    assert types.parse_declared("DECIMAL(12, 2)").spark_type == "decimal(12,2)"
    assert types.parse_declared("DATETIME2").spark_type == "timestamp_ntz"
    assert types.parse_declared("BIT").is_bit
    assert types.parse_declared("GEOGRAPHY").max_length == types.FALLBACK_LENGTH


def test_convert_and_errors(spark):
    df = spark.createDataFrame([("12",), ("12x",), ("",), (None,)], "v string")
    dt = types.parse_declared("INT")
    out = df.select(types.convert(F.col("v"), dt).alias("x"),
                    types.conversion_error(F.col("v"), types.convert(F.col("v"), dt), dt).alias("e"))
    rows = [(r["x"], r["e"]) for r in out.collect()]
    assert rows == [(12, False), (None, True), (None, False), (None, False)]


def test_names():
    assert sk_column_for("[DW].[Dim_Places]") == "Places_SK"
    assert qualify("[Dim_X]") == "dbo.Dim_X" and qualify("DW.Dim_X") == "DW.Dim_X"


def test_typed_load_declared_types(spark):
    from dimkiln.operators import typed_load as TL
    from dimkiln.spec import DimensionSpec
    spec = DimensionSpec(
        name="T", keys=("k",), type1=("flag", "day", "at", "amount", "note", "other"),
        required=("k",),
        types={"k": "INT", "flag": "BIT", "day": "DATE", "at": "DATETIME2",
               "amount": "DECIMAL(5,2)", "note": "NVARCHAR(MAX)", "other": "GEOGRAPHY"})
    rows = [("1", "1", "2024-01-31", "2024-01-31 10:20:30", "123.45", "x" * 9000, "ok"),
            ("2", "yes", "2024-02-30", "31/01/2024", "1234.5", None, "y" * 8001),
            (" ", "0", "", "", "", "", "")]
    text = spark.createDataFrame(rows, "k string, flag string, day string, at string, "
                                       "amount string, note string, other string")
    out = TL.split(text, spec)
    good = out.good.collect()
    assert len(good) == 1
    g = good[0]
    assert (g["k"], g["flag"], str(g["day"]), str(g["at"]), str(g["amount"])) == \
        (1, 1, "2024-01-31", "2024-01-31 10:20:30", "123.45")
    assert len(g["note"]) == 9000                      # MAX: no length limit
    reasons = {r["k"]: r["Rejected_Reason"] for r in out.rejects.collect()}
    assert reasons["2"] == ("TYPE_ERROR: day='2024-02-30' is not DATE; "
                            "TYPE_ERROR: at='31/01/2024' is not DATETIME2; "
                            "TYPE_ERROR: amount='1234.5' is not DECIMAL(5,2); "
                            "TOO_LONG: other > 8000")
    assert reasons[" "] == "NULL_KEY: k"               # blank key; blank values are NULL, not errors


def test_text_from_numbers_skips_identity_cleanup(spark):
    from dimkiln.sources.files import TYPED_ORIGIN, as_text_frame
    df = spark.createDataFrame([(1, 2.5, " a  b\\c ")], "n int, x double, s string")
    t = as_text_frame(df)
    tagged = {f.name for f in t.schema.fields if TYPED_ORIGIN in f.metadata}
    assert tagged == {"n", "x"}
    out = text.sanitize_frame(t, ["n", "x", "s"]).first()
    assert (out["n"], out["x"], out["s"]) == ("1", "2.5", "a b c")
