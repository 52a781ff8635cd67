from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from feedlens.functions import redact, text
from feedlens.operators import filters, keywords, language, tokens, wordfreq


def one(spark, value, fn):
    df = spark.createDataFrame([(value,)], "t string")
    return df.select(fn(F.col("t")).alias("x")).first()["x"]


def test_min_length_counts_code_points(make):
    kept = filters.min_length(make({"text": "я" * 19}, {"text": "я" * 20}, {"text": "🌍" * 21}))
    assert {r.id_ for r in kept.collect()} == {"1", "2"}


def test_non_empty(make):
    assert filters.non_empty(make({"text": None}, {"text": ""}, {"text": " "})).count() == 1


@pytest.mark.parametrize(
    ("value", "wanted"),
    [
        ("Food, food! The 12 tents.", ["food", "food", "the", "12", "tents"]),
        ("don't a_b", ["dont", "a_b"]),
        ("Привіт, світ !", ["привіт", "світ"]),
        ("", []),
        (None, None),
    ],
)
def test_words(spark, value, wanted):
    assert one(spark, value, text.words) == wanted


def test_strip_takes_every_white_space(spark):
    assert one(spark, " \t x y 　\n", text.strip) == "x y"


@pytest.mark.parametrize(
    ("value", "wanted"),
    [
        ("a\r\nb\n\nc", "a b c"),
        ("see https://x.org/a?b=1 now", "see <URL> now"),
        ("see www.x.org", "see <URL>"),
        ("hi 🌍👍🏽 There", "hi There"),
        (" Keep CASE ", "Keep CASE"),
    ],
)
def test_clean_text(spark, value, wanted):
    assert one(spark, value, text.clean_text) == wanted


@pytest.mark.parametrize(
    ("value", "wanted"),
    [
        ("mail a.b@c.example.com.", "mail [email]."),
        ("call +1 (743) 555-3824 now", "call [phone] now"),
        ("ip 10.0.0.1 up", "ip [ip] up"),
        ("card 4785380592391139$", "card [card]$"),
        ('token = "24be64439e"', "token = [secret]"),
        ("go https://a.b/c?d=e@f now", "go [url] now"),
        ("nothing here: 12", "nothing here: 12"),
        (None, None),
    ],
)
def test_redact(spark, value, wanted):
    assert one(spark, value, redact.redact) == wanted


def test_redact_one_kind_only(spark):
    assert one(spark, "a@b.org 10.0.0.1", lambda t: redact.redact(t, ["ip"])) == "a@b.org [ip]"


def test_keyword_single_needs_word_bounds_and_multi_does_not(make):
    rows = make({"text": "IFRC!"}, {"text": "a_ifrc"}, {"text": "ifrc2"}, {"text": "With them"}, {"text": None})
    flagged = keywords.keyword_flag(rows, ["ifrc", "with the"])
    assert {r.id_: r.keyword_flag for r in flagged.collect()} == {
        "0": True, "1": False, "2": False, "3": True, "4": False,
    }


@pytest.mark.parametrize("word", ["c++", "a.b", "x|y", "[z]"])
def test_keyword_is_literal(make, spark, word):
    rows = make({"text": f"about {word} here"}, {"text": "about cc ab x z"})
    table = spark.createDataFrame([(word,)], "keyword string")
    for limit in (10, 0):
        flagged = keywords.keyword_flag(rows, table, max_inline=limit)
        assert {r.id_: r.keyword_flag for r in flagged.collect()} == {"0": True, "1": False}


def test_keyword_join_keeps_null_groups(make, spark):
    rows = make({"text": "ifrc", "group": None}, {"text": "other", "group": None})
    table = spark.createDataFrame([("IFRC",)], "keyword string")
    flagged = keywords.keyword_flag(rows, table, max_inline=0)
    assert {r.id_: r.keyword_flag for r in flagged.collect()} == {"0": True, "1": False}


def test_language_vote_ties_and_silence(make, spark):
    stop = spark.createDataFrame(
        [("en", "the"), ("de", "der"), ("fr", "de"), ("es", "de")], "lang string, word string"
    )
    rows = make({"text": "The der the"}, {"text": "de"}, {"text": "nothing"}, {"text": None})
    for limit in (10, 0):
        got = language.detect_language(rows, stop, max_inline=limit)
        assert {r.id_: r.detected_lang for r in got.collect()} == {"0": "en", "1": "es", "2": None, "3": None}


def test_class_votes_count_phrases_and_ignore_empty_terms(make, spark):
    table = spark.createDataFrame([("x", "a b"), ("x", ""), ("x", "ok")], "label string, word string")
    for limit in (10, 0):
        got = tokens.class_votes(make({"text": "a b ok ok"}), table, "label", F.col("text"), max_inline=limit)
        assert got.select(tokens.votes_for(F.col("_votes"), "x")).first()[0] == 3


def test_votes_of_a_long_table_are_counted_before_anything_is_exchanged(make, spark, capsys):
    table = spark.createDataFrame([("x", "a b"), ("x", "ok"), ("y", "ok"), ("y", "b")], "label string, word string")
    texts = ["a b ok ok", "a b ok ok", "OK, b a", "a b a b", None, "", "none", "none"]
    rows = make(*({"text": t} for t in texts))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for distinct in (True, False):
            found = []
            for limit in (10, 0):
                got = tokens.class_votes(rows, table, "label", F.col("text"), distinct=distinct, max_inline=limit)
                found.append({r.id_: [tuple(v) for v in r._votes] for r in got.collect()})
            assert found[0] == found[1] and len(found[0]) == len(texts)
        got.explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    exchanged = [part for part in capsys.readouterr().out.split("\n\n") if ") Exchange" in part]
    assert exchanged and not any("_words" in part for part in exchanged)


def test_word_frequency(make, spark):
    stop = spark.createDataFrame([("en", "the")], "lang string, word string")
    got = wordfreq.word_frequency(make({"text": "Food, food! The 12 tents."}), stop)
    assert {r.word: r.frequency for r in got.collect()} == {"food": 2, "tents": 1}


def test_word_frequency_joins_lemmas_and_drops_their_dot(make, spark):
    stop = spark.createDataFrame([("en", "be")], "lang string, word string")
    lemmas = spark.createDataFrame(
        [("is", "be"), ("tents", "tent"), ("mr", "mr."), ("st", "mr")], "word string, lemma string"
    )
    got = wordfreq.word_frequency(make({"text": "is tents tent mr st"}), stop, lemmas)
    assert {r.word: r.frequency for r in got.collect()} == {"tent": 2, "mr": 2}


def test_most_frequent_orders_ties_by_word(make, spark):
    stop = spark.createDataFrame([], "lang string, word string")
    got = wordfreq.most_frequent(wordfreq.word_frequency(make({"text": "b a c c"}), stop), 2)
    assert [r.word for r in got.collect()] == ["c", "a"]


def test_null_guards(make):
    rows = make({"country": None}, {"source": None}, {"datetime_": None}, {})
    assert filters.null_counts(rows).first().asDict() == {"null_datetime": 1, "null_country": 1, "null_source": 1}
    with pytest.raises(Exception, match="specify country"):
        filters.require_not_null(make({"country": None})).collect()
    assert filters.require_not_null(make({})).count() == 1


def test_ranges(make):
    rows = make(
        {"datetime_": "2023-11-29 15:00:00"}, {"datetime_": "2023-11-29 17:00:00"},
        {"datetime_": "2023-11-29T17:00:01"}, {"country": "UKR", "datetime_": "2023-11-29 16:00:00"},
    )
    got = filters.required_range(rows, "2023-11-29 15:00:00", "2023-11-29 17:00:00", "NLD", "Telegram")
    assert {r.id_ for r in got.collect()} == {"0", "1"}
    assert {r.id_ for r in filters.optional_range(rows, country="UKR").collect()} == {"3"}
    assert filters.optional_range(rows).count() == 4
    with pytest.raises(ValueError, match="country"):
        filters.required_range(rows, "a", "b", None, "Telegram")


def test_since_is_cut_to_the_day(make):
    rows = make({"datetime_": "2023-11-15 00:00:00"}, {"datetime_": "2023-11-14 23:59:59"})
    assert {r.id_ for r in filters.since(rows, "2023-11-29 17:00:00").collect()} == {"0"}
