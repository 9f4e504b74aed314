import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import LONG_EN, LONG_FR
from newsloom.functions import dates, numbers, text


def apply(spark, value, fn, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(fn(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize(
    "given_text, expected",
    [
        ("<p>Hello <b>world</b></p>", "Hello world"),
        ("Visit https://example.com/page for info", "Visit for info"),
        ("Go to www.example.com now", "Go to now"),
        ("Rock &amp; Roll &nbsp; fun", "Rock Roll fun"),
        ("Price &#163;50", "Price 50"),
        ("Hello\x00\x01\x02World", "HelloWorld"),
        ("a\tb\x7fc\nd", "a\tbc\nd"),
        ("Hello    world", "Hello world"),
        ("Line1\n\n\n\nLine2", "Line1\n\nLine2"),
        ("  hello   ", "hello"),
        ("", ""),
        ("   ", ""),
        (None, ""),
        ("An ordinary sentence.", "An ordinary sentence."),
        ("2 < 3 and 4", "2 < 3 and 4"),
    ],
)
def test_clean_text(spark, given_text, expected):
    assert apply(spark, given_text, lambda c: text.clean_text("v")) == expected


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab <>&;#1/:.wht\n\t \x01", max_size=40), min_size=20, max_size=60))
def test_cleaned_text_has_no_markup_left(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for (out,) in df.select(text.clean_text("v")).collect():
        assert out == out.strip() and "  " not in out and "\n\n\n" not in out and "\x01" not in out


@pytest.mark.parametrize(
    "url, ok",
    [
        ("http://example.com", True),
        ("https://example.com/path?q=1", True),
        ("HTTPS://EXAMPLE.COM", True),
        ("", False),
        (None, False),
        ("example.com", False),
        ("https://", False),
        ("https://ab c.com", False),
        ("https://a", False),
        ("not-a-url", False),
    ],
)
def test_url(spark, url, ok):
    assert apply(spark, url, text.is_url_valid) is ok


@pytest.mark.parametrize(
    "value, lang",
    [(LONG_FR, "fr"), (LONG_EN, "en"), ("hi", "unknown"), ("", "unknown"), (None, "unknown"),
     ("هذا نص طويل بما يكفي لاختبار اللغة العربية", "ar"), ("xyzzy plugh qwerty uiopas dfghj", "unknown")],
)
def test_language(spark, value, lang):
    assert apply(spark, value, lambda c: text.detect_language("v")) == lang


def test_title_terms_are_cut_before_punctuation_goes(spark):
    assert sorted(apply(spark, "Gaza: US (2024) a!! 'The' 123 ...", lambda c: text.title_terms("v"))) == ["2024", "a", "gaza", "the"]


def test_translation_passes_unknown_words_through(spark):
    assert apply(spark, "guerre", lambda c: text.translate("v")) == "war"
    assert apply(spark, "chicken", lambda c: text.translate("v")) == "chicken"


@pytest.mark.parametrize(
    "label, terms",
    [
        ("0_us_biden_trump", ["biden", "trump", "us"]),
        ("3_guerre_gaza", ["gaza", "guerre", "war"]),
        ("5_the_of_and", ["of", "the"]),
        ("7", None),
        ("hors-sujet", None),
        ("-1_noise", None),
        ("", None),
        (None, None),
    ],
)
def test_label_terms(spark, label, terms):
    assert apply(spark, label, lambda c: text.label_search_terms("v")) == terms


@pytest.mark.parametrize(
    "label, name",
    [
        ("0_iran_nuclear", "Iran"),
        ("4_football_ligue_match", "Football Ligue"),
        ("hors-sujet", "hors-sujet"),
        ("9_of_it", "Actualité Internationale"),
        ("8_focus_group", "États-Unis"),  # "us" inside a word counts here
        ("", ""),
        (None, None),
    ],
)
def test_label_name(spark, label, name):
    assert apply(spark, label, text.clean_topic_label) == name


def test_market_entity_is_stricter(spark):
    assert apply(spark, "Focus on farming", lambda c: text.market_entity(c, F.lit(None))) == "Actualité Internationale"
    assert apply(spark, "Focus on farming", lambda c: text.article_entity(c, F.lit(None))) == "États-Unis"
    assert apply(spark, "Talks in New Delhi", lambda c: text.market_entity(c, F.lit(""))) == "Inde / Pakistan"


def test_relevance(spark):
    rows = [
        ("Will Morocco win?", "Le Maroc gagne", "1_sport", True),
        ("Will it rain?", "Le Maroc gagne", "1_sport", False),
        ("Will it rain?", "", "", True),
        ("", "x", "y", True),
        (None, "x", "y", True),
    ]
    df = spark.createDataFrame(rows, "q string, t string, l string, ok boolean")
    out = df.select(text.question_is_relevant("q", "t", "l").alias("got"), "ok").collect()
    assert [r["got"] for r in out] == [r["ok"] for r in out]


def as_text(fn):
    return lambda c: F.date_format(fn(c), "yyyy-MM-dd HH:mm:ss")


@pytest.mark.parametrize(
    "raw, out",
    [
        ("2025-04-26T10:00:00", "2025-04-26 10:00:00"),
        ("2025-04-26T10:00:00.123456", "2025-04-26 10:00:00"),
        ("2025-04-26T10:00:00+02:00", "2025-04-26 08:00:00"),
        ("2025-04-26", "2025-04-26 00:00:00"),
        ("  ", None),
        (None, None),
        ("yesterday", None),
    ],
)
def test_mixed_dates(spark, raw, out):
    assert apply(spark, raw, as_text(dates.mixed_timestamp)) == out


@pytest.mark.parametrize(
    "raw, out",
    [
        ("Sat, 26 Apr 2025 10:00:00 +0000", "2025-04-26 10:00:00"),
        ("Sat, 26 Apr 2025 10:00:00 GMT", "2025-04-26 10:00:00"),
        ("26 Apr 2025 10:00:00 -0500", "2025-04-26 15:00:00"),
        ("", None),
        ("soon", None),
    ],
)
def test_feed_dates(spark, raw, out):
    assert apply(spark, raw, as_text(dates.rfc822_timestamp)) == out


def test_compact_dates(spark):
    now = F.lit("2025-01-01").cast("timestamp")
    read = lambda c: dates.compact_to_iso(c, now)
    assert apply(spark, "20250426T100000Z", read) == "2025-04-26T10:00:00"
    assert apply(spark, "", read) == "2025-01-01T00:00:00"
    assert apply(spark, "bad", read) == "bad"


@pytest.mark.parametrize(
    "prices, p",
    [("['0.62', '0.38']", 0.62), ('["0.1", "0.9"]', 0.1), ("[0.25, 0.75]", 0.25), ("[]", 0.5), ("oops", 0.5), (None, 0.5), ("['x']", 0.5)],
)
def test_outcome_price(spark, prices, p):
    assert apply(spark, prices, numbers.outcome_price) == p


def test_display_probability_never_replaces_the_stored_one(spark):
    df = spark.createDataFrame([(0.995, "t"), (0.4, "t"), (None, "t")], "p double, t string")
    out = df.select("p", numbers.display_prob(F.col("p"), F.col("t")).alias("d"), numbers.is_extreme(F.col("p")).alias("x")).collect()
    assert out[0]["p"] == 0.995 and 0.58 <= out[0]["d"] <= 0.88 and out[0]["x"]
    assert out[1]["d"] == 0.4 and not out[1]["x"]
    assert out[2]["d"] is None and not out[2]["x"]


def test_bands_and_rounding(spark):
    band = lambda c: numbers.signal_band(c)
    assert [apply(spark, v, band, "double") for v in (0.7, 0.4, 0.39, 3.0, -1.0)] == ["high", "medium", "low", "high", "low"]
    assert apply(spark, 0.12345, numbers.round4, "double") == 0.1234
    assert apply(spark, 0.625, numbers.percent, "double") == "62.5%"
