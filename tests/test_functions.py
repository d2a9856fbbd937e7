import datetime
import unicodedata

import pytest
from pyspark.sql import functions as F

from stormgrid import defaults as D
from stormgrid.functions import (
    at_least, calendar, clean_column_name, fold, in_months, log1p0, nan_to_null,
    normalize_ascii, normalize_key, normalize_text, null_if_token, parse_day, parse_ymd,
    right_bins, strip, to_int, to_number,
)


def col(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"c {kind}")


def apply(spark, values, fn, kind="string"):
    return [r[0] for r in col(spark, values, kind).select(fn(F.col("c"))).collect()]


def decompose(text):
    return "".join(
        p for p in unicodedata.normalize("NFKD", text) if unicodedata.combining(p) == 0
    )


def test_fold_matches_unicode_tables_everywhere(spark):
    codes = [c for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    texts = ["".join(map(chr, codes[i:i + 96])) for i in range(0, len(codes), 96)]
    df = spark.createDataFrame([(t, decompose(t)) for t in texts], "c string, want string")
    assert df.filter(~fold(F.col("c")).eqNullSafe(F.col("want"))).count() == 0


def test_fold_mixed_tiers_and_hangul(spark):
    texts = ["plain", "Inundación", "½ ¼ ¾ ﬁn", "서울 한국", "Ångström Ő ﷺ", "áë", None]
    assert apply(spark, texts, fold) == [t and decompose(t) for t in texts]


def test_strip_takes_all_white_space(spark):
    texts = ["\t x \n", " x ", "\x1cx\x1f", "　x", " x\u0085", "x y"]
    assert apply(spark, texts, strip) == [t.strip() for t in texts]


def test_normalize_key(spark):
    texts = [" Álvaro Obregón\t", "ñandú", "Straße", "", None]
    assert apply(spark, texts, normalize_key) == ["ALVARO OBREGON", "NANDU", "STRASSE", "", None]


def test_normalize_text(spark):
    texts = ["  Aguas \t Negras  ", "Inundación", "", None]
    assert apply(spark, texts, normalize_text) == ["aguas negras", "inundacion", "", ""]


def test_normalize_ascii_drops_what_does_not_fold(spark):
    texts = [" Cuauhtémoc ", "straße Ωmega", "日本", "", None]
    assert apply(spark, texts, normalize_ascii) == ["CUAUHTEMOC", "STRAE MEGA", "", "", ""]


def test_clean_column_name():
    assert clean_column_name("  Fuga de Agua/Gas ") == "fuga_de_agua_gas"


def test_to_number(spark):
    texts = ["1.5", " 2 ", "1e3", "-.5", "n/d", "", "1.5d", "0x10", "NaN", "inf", None, "1,5"]
    got = apply(spark, texts, to_number)
    assert got == [1.5, 2.0, 1000.0, -0.5, None, None, None, None, None, float("inf"), None, None]


def test_to_int_accepts_float_text(spark):
    assert apply(spark, ["1.0", "0", "x", None], to_int) == [1, 0, None, None]


def test_nan_is_missing(spark):
    assert apply(spark, [1.0, float("nan"), None], nan_to_null, "double") == [1.0, None, None]


def test_missing_value_words(spark):
    assert apply(spark, ["NA", "", "null", "naval"], null_if_token) == [None, None, None, "naval"]


def test_parse_ymd(spark):
    got = apply(spark, ["20190102", "20191301", "2019-01-02", "201901", None], parse_ymd)
    assert got == [datetime.date(2019, 1, 2), None, None, None, None]
    assert apply(spark, [20190102], parse_ymd, "long") == [datetime.date(2019, 1, 2)]


@pytest.mark.parametrize("text, want", [
    ("2021-03-04 05:06:07", (2021, 3, 4)), ("2021-03-04 05:06:07.123", (2021, 3, 4)),
    ("2021-03-04T23:59:59", (2021, 3, 4)), ("2021-03-04", (2021, 3, 4)),
    (" 2021/03/04 ", (2021, 3, 4)), ("3/4/2021", (2021, 3, 4)), ("12/31/2021 23:59", (2021, 12, 31)),
    ("31/12/2021", None), ("pendiente", None), ("", None), (None, None),
])
def test_parse_day(spark, text, want):
    assert apply(spark, [text], parse_day) == [want and datetime.date(*want)]


def test_parse_day_takes_the_first_format_that_fits(spark):
    day_first = apply(spark, ["03/04/2021"], lambda c: parse_day(c, ["dd/MM/yyyy", "M/d/yyyy"]))
    assert day_first == [datetime.date(2021, 4, 3)]
    named = apply(spark, ["04 Mar 2021"], lambda c: parse_day(c, ["dd MMM yyyy"]))
    assert named == [datetime.date(2021, 3, 4)]


def test_at_least_counts_missing_as_zero(spark):
    got = apply(spark, [5.0, 4.9, None, 6.0], lambda c: at_least(c, 5), "double")
    assert got == [1, 0, 0, 1]


def test_calendar_monday_is_zero(spark):
    df = col(spark, [datetime.date(2024, 1, 1), datetime.date(2024, 12, 29)], "date")
    got = [tuple(r)[1:] for r in calendar(df, "c").collect()]
    assert got == [(1, 1, 0), (12, 4, 6)]


def test_in_months(spark):
    days = [datetime.date(2024, m, 1) for m in (5, 6, 10, 11)] + [None]
    assert apply(spark, days, lambda c: in_months(c, D.SEASON_MONTHS), "date") == [0, 1, 1, 0, 0]


def test_log1p0(spark):
    got = [r["c_log"] for r in log1p0(col(spark, [0.0, None, 1.0], "double"), ["c"]).collect()]
    assert got == [0.0, 0.0, pytest.approx(0.6931471805599453, abs=1e-15)]


def test_right_bins_edges(spark):
    p = [0.0, 0.33, 0.3300001, 0.66, 0.67, 1.0, 1.01, -0.01, None]
    got = apply(spark, p, lambda c: right_bins(c, D.RISK_EDGES, D.RISK_LABELS), "double")
    assert got == ["BAJO", "BAJO", "MEDIO", "MEDIO", "ALTO", "ALTO", None, None, None]
    with pytest.raises(ValueError):
        right_bins(F.lit(0.5), [0, 1], ["a", "b"])
