"""Column functions against plain Python."""

from __future__ import annotations

import datetime as dt
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from terrace import config
from terrace.functions.casts import strict_double, strict_int
from terrace.functions.dates import date_key, elapsed_days, form_of, parse_timestamp
from terrace.functions.text import blank_to_null, clean_city, clean_label, strip_accents, strip_space, zero_pad


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row[0] for row in df.orderBy("i").select(function(F.col("v"))).collect()]


def plain_fold(text):
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def test_strip_accents_agrees_on_every_character(spark):
    texts = [
        "".join(chr(c) for c in range(start, start + 256) if not 0xD800 <= c <= 0xDFFF)
        for start in range(0, 0x30000, 256)
    ]
    assert apply(spark, strip_accents, texts) == [plain_fold(t) for t in texts]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"])), min_size=20, max_size=60))
def test_strip_accents_on_random_text(spark, texts):
    assert apply(spark, strip_accents, texts) == [plain_fold(t) for t in texts]


def test_clean_city(spark):
    texts = [" São Paulo ", "SÃO JOÃO D'OESTE", "\tNiterói", "ã", "1º", "đ", "ﬁ", None]
    assert apply(spark, clean_city, texts) == [
        "sao paulo", "sao joao d'oeste", "niteroi", "a", "1o", "đ", "fi", None,
    ]


def test_strip_space_like_python(spark):
    texts = ["\x1f　 a b \x85\n", "", " ", "a"]
    assert apply(spark, strip_space, texts) == [t.strip() for t in texts]
    assert apply(spark, clean_label, [" Delivered", "SHIPPED", None]) == ["delivered", "shipped", None]


def test_zero_pad_like_python(spark):
    texts = ["1037", "01037", "123456", "", "-12", "+1", "-123456"]
    assert apply(spark, zero_pad, texts) == [t.zfill(5) for t in texts]
    assert apply(spark, zero_pad, [None]) == [None]
    assert apply(spark, zero_pad, [1037], "int") == ["01037"]


def test_missing_value_tokens(spark):
    assert apply(spark, blank_to_null, [*config.NA_TOKENS, None]) == [None] * (len(config.NA_TOKENS) + 1)
    assert apply(spark, blank_to_null, [" ", "none", "0"]) == [" ", "none", "0"]


def test_parse_timestamp(spark):
    texts = ["2018-01-01 10:00:00", "junk", "2018-13-01 00:00:00", "2018", "20180101", None]
    assert apply(spark, parse_timestamp, texts) == [dt.datetime(2018, 1, 1, 10)] + [None] * 5
    forms = ["2018-01-02", "2018-01-02T10:00:00", "2018-01-02 10:00:00.123456789", "2018-01-02 10:00", "2018/1/2", "01/02/2018 10:00:00"]
    day, ten = dt.datetime(2018, 1, 2), dt.datetime(2018, 1, 2, 10)
    assert apply(spark, parse_timestamp, forms) == [day, ten, ten.replace(microsecond=123456), ten, day, ten]
    # With a form, the other forms are no moments.
    for text, form, whole in zip(forms, ["date", "t_seconds", "fraction", "minutes", "slashes", "month_first"], apply(spark, parse_timestamp, forms), strict=True):
        assert form_of(text) == form
        assert apply(spark, lambda c, form=form: parse_timestamp(c, form), forms) == [whole if t == text else None for t in forms]
    assert form_of("junk") is None and form_of(None) is None


def test_timestamps_ignore_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        # This local time was skipped by daylight saving.
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        text = "2018-11-04 00:30:00"
        df = spark.createDataFrame([(text,)], "v string").select(
            parse_timestamp(F.col("v")).cast("string"), date_key(parse_timestamp(F.col("v")))
        )
        assert df.first() == (text, 20181104)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_elapsed_days_rounds_down(spark):
    estimate = dt.datetime(2018, 1, 10, 23)
    hours = [-1, 13, 24, -24, 0, 23, -25]
    rows = [(estimate, estimate + dt.timedelta(hours=h)) for h in hours] + [(estimate, None)]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz").select(
        elapsed_days(F.col("a"), F.col("b"))
    )
    assert [r[0] for r in df.collect()] == [-1, 0, 1, -1, 0, 0, -2, None]


def test_date_key(spark):
    moments = [dt.datetime(2018, 1, 2, 23, 59), None]
    assert apply(spark, date_key, moments, "timestamp_ntz") == [20180102, -1]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_casts(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert apply(spark, strict_double, ["1.5", None, "2"]) == [1.5, None, 2.0]
        assert apply(spark, lambda c: strict_int(c, "n"), ["1", "2.0"]) == [1, 2]
        for bad in ([None], ["x"], [""]):
            with pytest.raises(PySparkException, match="n must be a number"):
                apply(spark, lambda c: strict_int(c, "n"), bad)
        with pytest.raises(PySparkException, match="not a number"):
            apply(spark, strict_double, ["x"])
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
