"""Column helpers and the semantic traps they encode."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake.functions import dates, numeric, text


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_pg_concat_skips_null_strict_concat_nulls(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    row = df.select(text.pg_concat("a", "b").alias("pg"), text.strict_concat("a", "b").alias("st")).first()
    assert row["pg"] == "a" and row["st"] is None


def test_normalize_text_rules(spark):
    f = text.normalize_text("v", 255)
    assert one(spark, f, "  Straße  Ñandú\t12!! ") == "STRASSE NANDU12"
    assert one(spark, f, "   ") is None
    assert one(spark, f, None) is None
    assert one(spark, f, "!!!") is None
    # cut to length happens before stripping
    assert one(spark, text.normalize_text("v", 3), "  abc") == "A"
    # whole text when length is None
    assert one(spark, text.normalize_text("v", None), "x" * 500) == "X" * 500


def test_transliteration_beyond_accented_letters(spark):
    # NBSP separates words, ordinal and superscript marks become letters/digits,
    # fullwidth forms become ASCII; a spacing diaeresis is spelled, not turned into a blank
    f = text.normalize_text("v", None)
    assert one(spark, f, "Nº\u00a01ª m² Ａｂｃ１２") == "NO 1A M2 ABC12"
    assert one(spark, text.clean_special("v"), "a\u00a8b\u00a0c") == 'a"b c'


def test_clean_special_transliterates_and_drops_controls(spark):
    assert one(spark, text.clean_special("v"), "Crème\nbrûlée\x07 ß") == "Cremebrulee ss"
    assert one(spark, text.clean_special("v"), None) is None


def test_regex_extract_longest_first_and_null(spark):
    pat = r"([0-9]+\s+(MESES|MES|ANOS|ANO))"
    assert one(spark, text.regex_extract_or_null("v", pat), "FIRMA 3 MESES") == "3 MESES"
    assert one(spark, text.regex_extract_or_null("v", pat), "FIRMA") is None


def test_trim_spaces_only_vs_strip_whitespace(spark):
    assert one(spark, text.trim_spaces("v"), " a\t") == "a\t"
    assert one(spark, text.strip_whitespace("v"), " \ta\n ") == "a"


def test_month_shift_clamps_month_end(spark):
    r = one(spark, dates.month_shift("v"), dt.date(2025, 3, 31), "v date")
    assert r == dt.date(2025, 2, 28)


def test_strict_timestamp_exact_format(spark):
    assert one(spark, dates.strict_timestamp("v"), "2024-01-05 03:04:05") == dt.datetime(2024, 1, 5, 3, 4, 5)
    assert one(spark, dates.strict_timestamp("v"), "2024-01-05") is None
    assert one(spark, dates.strict_timestamp("v"), "2024-02-30 00:00:00") is None


def test_pg_month_and_day_names_are_padded(spark):
    d = dt.date(2024, 5, 4)  # a Saturday in May
    assert one(spark, dates.month_name_padded("v"), d, "v date") == "May      "
    assert one(spark, dates.day_name_padded("v"), d, "v date") == "Saturday "
    assert one(spark, dates.is_weekend("v"), d, "v date") is True


def test_timestamp_text_fraction_only_when_nonzero(spark):
    assert one(spark, dates.timestamp_text("v"), dt.datetime(2024, 1, 1, 1, 2, 3), "v timestamp_ntz") \
        == "2024-01-01 01:02:03"
    assert one(spark, dates.timestamp_text("v"), dt.datetime(2024, 1, 1, 1, 2, 3, 250000), "v timestamp_ntz") \
        == "2024-01-01 01:02:03.25"


def test_div_round_half_up_signs_and_zero(spark):
    df = spark.createDataFrame([(5, 2), (-5, 2), (5, -2), (4, 3), (1, 0)], "n long, d long")
    got = [r[0] for r in df.select(numeric.div_round_half_up("n", "d")).collect()]
    assert got == [3, -3, -3, 1, None]


def test_div_round_half_up_on_wide_decimals(spark):
    # operands wider than a long; the quotient itself must fit in a long
    df = spark.createDataFrame([(Decimal("1234567890123456789500000"), Decimal("1000000"))],
                               "n decimal(38,0), d decimal(38,0)")
    assert df.select(numeric.div_round_half_up("n", "d")).first()[0] == 1234567890123456789 + 1


def test_round_half_up_on_decimal_is_away_from_zero(spark):
    df = spark.createDataFrame([(Decimal("-1.205"), Decimal("2.675"))], "a decimal(18,4), b decimal(18,4)")
    r = df.select(numeric.round_half_up("a", 2), numeric.round_half_up("b", 2)).first()
    assert r[0] == Decimal("-1.21") and r[1] == Decimal("2.68")


def test_allocate_cents_closes_simple_invoice(spark):
    # lines 100 + 200 cents, header 301 cents: the cent goes to the larger line
    df = spark.createDataFrame([(100,), (200,)], "c long").withColumn("s", F.lit(300)).withColumn("h", F.lit(301))
    got = sorted(r[0] for r in df.select(numeric.allocate_cents("c", "s", "h")).collect())
    assert got == [100, 201]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0)], "x double, s double")
    got = [r[0] for r in df.select(numeric.safe_ratio("x", "s"), ).collect()]
    assert got == [0.0, 0.25]


def test_every_code_point_is_spelled_by_the_rule(spark):
    from pyspark.sql import functions as F
    points = [cp for cp in range(1, 0x11000) if not 0xD800 <= cp < 0xE000] + [0x1F600, 0x20000, 0x1D400]
    lines = ["".join(map(chr, points[i:i + 97])) for i in range(0, len(points), 97)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, v string")
    for i, got in df.select("i", text.transliterate("v")).collect():
        want = "".join(text.spelling(c) if ord(c) < 0x3100 or 0xF900 <= ord(c) < 0x10000 else "" for c in lines[i])
        assert got == want and got.isascii()
    assert one(spark, text.transliterate("v"), None) is None and one(spark, text.transliterate("v"), "") == ""
    # combining marks vanish, so composed and decomposed text are spelled alike
    import unicodedata
    latin = "".join(chr(c) for c in range(0xC0, 0x250))
    for form in ("NFC", "NFD"):
        assert one(spark, text.transliterate("v"), unicodedata.normalize(form, "\u00e9\u00f1\u00fc\u015f\u01d5")) == "enusU"
    assert one(spark, F.length(text.transliterate("v")), latin) >= 300
