import hashlib
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import (
    add_amounts, clean_text, collapse_spaces, parse_number, parse_utc, python_repr, title_case,
)
from ledgerloom.functions.hashing import business_hash
from ledgerloom.functions.money import discount_cents, to_cents
from ledgerloom.functions.text import WHITESPACE


def apply(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["out"] for r in df.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()]


def test_whitespace_is_every_unicode_space():
    assert set(WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_clean_text_strips_unicode_space_and_blanks_become_null(spark):
    raw = ["  a b ", " x　", "\x1c\t\n", "", None, "plain"]
    assert apply(spark, raw, clean_text) == ["a b", "x", None, None, None, "plain"]


@pytest.mark.parametrize("text", [
    "  quezon   city ", "quezon-city o'neil 3rd", "ÉCOLE élan", "中a b", "x1y2z", "MCDONALD'S", "a b\x1c",
])
def test_title_case_matches_python(spark, text):
    got = apply(spark, [text], lambda c: title_case(collapse_spaces(clean_text(c))))
    assert got == [" ".join(text.split()).title()]


@pytest.mark.parametrize("text", ["two", "it's", 'say "hi"', "both ' and \"", "a\\b", "l1\nl2", ""])
def test_repr_in_reason_messages(spark, text):
    assert apply(spark, [text], python_repr) == [repr(text)]


TIMESTAMPS = {
    "2025": "2025-01-01T00:00:00.000000", "2025-01": "2025-01-01T00:00:00.000000",
    "2025-01-05": "2025-01-05T00:00:00.000000", "20250105": "2025-01-05T00:00:00.000000",
    "2025/01/05": "2025-01-05T00:00:00.000000", "2025-1-5": "2025-01-05T00:00:00.000000",
    "2025-01-05T10": "2025-01-05T10:00:00.000000", "2025-01-05T1000": "2025-01-05T10:00:00.000000",
    "20250105T100000Z": "2025-01-05T10:00:00.000000", "2025-01-05T10Z": "2025-01-05T10:00:00.000000",
    "2025-01-05 10:00:00.1234567891": "2025-01-05T10:00:00.123456",
    "2025-01-05T18:00:00+08:00": "2025-01-05T10:00:00.000000",
    "2025-01-05T10:00:00 -0130": "2025-01-05T11:30:00.000000", " 2025-01-05 ": "2025-01-05T00:00:00.000000",
    "now": None, "today": None, "T10:00": None, "202501": None, "2025-13-01": None, "2025-02-30": None,
    "2025-01-05T24:00:00": None, "2025-01-05T10:00:00 Europe/Paris": None, "2025-01-05Z": None,
    "1600-01-01": None, "2262-04-11": "2262-04-11T00:00:00.000000", "2262-04-12": None, "": None, None: None,
    "2025-01-05T10:00:00z": None, "nan": None, "2025-W01": None,
}


def test_parse_utc(spark):
    form = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    got = apply(spark, list(TIMESTAMPS), lambda c: F.date_format(parse_utc(c), form))
    assert dict(zip(TIMESTAMPS, got)) == TIMESTAMPS


def test_parse_number(spark):
    inf = float("inf")
    cases = {"1": 1.0, " +1 ": 1.0, ".5": 0.5, "5.": 5.0, "1e3": 1000.0, "1d": None, "0x10": None, "inf": inf,
             "-Infinity": -inf, "nan": None, "1,000": None, "1_000": None, "1e400": None, "two": None, "": None,
             "１": None, "-0": -0.0, "1e-400": 0.0}
    assert apply(spark, list(cases), parse_number) == list(cases.values())


def test_cents_round_half_even_and_discount_half_up(spark):
    assert apply(spark, [1.005, 2.675, 0.125, 48375.06], to_cents, "double") == [100, 268, 12, 4837506]
    df = spark.createDataFrame([(4837506, 1000), (1, 5000), (3, 5000), (9_000_000_000_000_000, 9999)],
                               "g bigint, bp bigint")
    got = [r[0] for r in df.select(discount_cents(F.col("g"), F.col("bp"))).collect()]
    assert got == [(g * bp + 5000) // 10000 for g, bp in
                   ((4837506, 1000), (1, 5000), (3, 5000), (9_000_000_000_000_000, 9999))]


def test_amounts_are_exact_decimals(spark):
    df = spark.createDataFrame([(1, 48375.06, 0.1)], "quantity bigint, unit_price double, discount_pct double")
    row = add_amounts(df).first()
    assert (row["gross_amount"], row["discount_amount"], row["net_amount"]) == (
        Decimal("48375.06"), Decimal("4837.51"), Decimal("43537.55"))


def test_hash_is_sha256_of_sorted_compact_json(spark):
    df = spark.createDataFrame(
        [("O1", "Ñ \"q\" \t ", 3, 10.5, 0.1, None)],
        "order_id string, brand string, quantity bigint, unit_price double, discount_pct double, status string",
    ).withColumn("order_timestamp", F.lit("2025-01-01T10:00:00.25Z").cast("timestamp"))
    columns = ("status", "order_id", "brand", "quantity", "unit_price", "discount_pct", "order_timestamp")
    want = {"order_id": "O1", "brand": "Ñ \"q\" \t ", "quantity": "3", "unit_price": "10.50",
            "discount_pct": "0.1000", "status": None, "order_timestamp": "2025-01-01T10:00:00.250000Z"}
    text = json.dumps(want, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert df.select(business_hash(columns)).first()[0] == hashlib.sha256(text.encode()).hexdigest()
