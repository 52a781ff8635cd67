from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from feedlens.functions import nested
from feedlens.operators import anonymize, classify, geo, translate
from feedlens.operators.contains import contains_join
from feedlens.plans.pipeline import Pipeline, enrich


def test_set_translation_replaces_or_appends(make):
    rows = make({"translations": [("x", "uk", "en")]})
    for pair, wanted in ((("uk", "en"), [("y", "uk", "en")]), (("ru", "en"), [("x", "uk", "en"), ("y", "ru", "en")])):
        new = nested.translation(F.lit("y"), F.lit(pair[0]), F.lit(pair[1]))
        got = rows.select(nested.set_translation(F.col("translations"), new).alias("t")).first().t
        assert [tuple(t) for t in got] == wanted


def test_add_translation_does_not_check(make):
    new = nested.translation(F.lit("x"), F.lit("uk"), F.lit("en"))
    rows = make({"translations": [("x", "uk", "en")]})
    assert len(rows.select(nested.add_translation(F.col("translations"), new)).first()[0]) == 2


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ([("w", 0.5, "model"), ("x", 0.9, "model"), ("y", 0.9, "model"), ("z", 1.0, "human")], ("x", 0.9, "model")),
        ([("z", 1.0, "human")], None),
        ([], None),
    ],
)
def test_top_model_classification(make, given, wanted):
    got = make({"classifications": given}).select(nested.top_model_classification(F.col("classifications"))).first()[0]
    assert (tuple(got) if got else None) == wanted


def test_text_to_classify(make):
    rows = make({"text": "a\nb", "translations": [("t1", "uk", "en"), ("t2", "ru", "en")]}, {"text": "a\nb"})
    for lang, wanted in ((None, ["a\nb", "a\nb"]), ("en", ["t1", "a b"])):
        got = rows.orderBy("id_").select(classify.text_to_classify(lang)).collect()
        assert [r[0] for r in got] == wanted


def test_sentiment_complement(make, spark):
    table = spark.createDataFrame([("good", 1), ("bad", -1)], "word string, sign int")
    rows = make({"text": "bad bad bad bad good"}, {"text": None}, {"text": "x"})
    for limit in (10, 0):
        got = {r.id_: [(c.topic, round(c.score, 6)) for c in r.classifications]
               for r in classify.classify_sentiment(rows, table, max_inline=limit).collect()}
        assert got == {
            "0": [("NEGATIVE", 0.8), ("POSITIVE", 0.2)], "1": [], "2": [("POSITIVE", 0.5), ("NEGATIVE", 0.5)],
        }


def test_labels_keep_their_order_and_count_terms_once(make, spark):
    terms = spark.createDataFrame([("b", "Tent"), ("b", "roof"), ("a", "food")], "label string, term string")
    for limit in (10, 0):
        got = classify.classify_labels(make({"text": "tent tent"}), terms, ["b", "a", "none"], max_inline=limit)
        assert [(c.topic, c.score) for c in got.first().classifications] == [("b", 0.5), ("a", 0.0), ("none", 0.0)]
    with pytest.raises(ValueError, match="labels"):
        classify.classify_labels(make({}), terms, [])


def test_trained_model_scores_every_class(make, spark):
    rows = [("water well", 0.0), ("water pump", 0.0), ("roof tent", 1.0), ("tent camp", 1.0)] * 3
    model = classify.fit_topics(spark.createDataFrame(rows, "text string, label double"))
    spark.range(3).observe(Observation("any"), F.count(F.lit(1)).alias("n")).collect()  # as the store does
    got = classify.classify_trained(make({"text": "the water"}, {"text": None}), model, ["water", "shelter"]).orderBy("id_").collect()
    first = got[0].classifications
    assert [c.topic for c in first] == ["water", "shelter"] and first[0].score > 0.5
    assert abs(sum(c.score for c in first) - 1) < 1e-9
    assert got[1].classifications == [] and got[1].text is None


def lexicon(spark):
    rows = [("de", "en", "und", "and"), ("de", "en", "der", "the"), ("de", "nl", "und", "en")]
    return spark.createDataFrame(rows, "from_lang string, to_lang string, word string, translation string")


def test_translate_pairs_and_passes_empty_text(make, spark):
    rows = make({"text": "Der Hund und"}, {"text": ""}, {"text": None})
    for limit in (10, 0):
        got = translate.translate_with_lexicon(rows, lexicon(spark), "de", ["en", "nl"], max_inline=limit)
        got = {r.id_: [tuple(t) for t in r.translations] for r in got.collect()}
        assert got["0"] == [("the Hund and", "de", "en"), ("Der Hund en", "de", "nl")]
        assert got["1"] == [("", "de", "en"), ("", "de", "nl")]
        assert got["2"] == [(None, "de", "en"), (None, "de", "nl")]
    with pytest.raises(ValueError, match="differ"):
        translate.translate_with_lexicon(rows, lexicon(spark), "en", "en")


def test_translate_detects_language(make, spark):
    stop = spark.createDataFrame([("de", "und"), ("en", "the")], "lang string, word string")
    rows = make({"text": "Hund und"}, {"text": "xyz"})
    got = translate.translate_with_lexicon(rows, lexicon(spark), "", "en", stop)
    assert {r.id_: tuple(r.translations[0]) for r in got.collect()} == {
        "0": ("Hund and", "de", "en"), "1": ("xyz", "", "en"),
    }


def test_translate_engine_runs_once_per_text_and_survives_failure(make, spark):
    seen = spark.sparkContext.accumulator(0)

    def good(source, target):
        def run(texts):
            seen.add(len(texts))
            return pd.DataFrame({"text": texts.str.upper()})

        return run

    def broken(source, target):
        def run(texts):
            raise RuntimeError("no service")

        return run

    rows = make({"text": "a"}, {"text": "a"}, {"text": "b"}, {"text": None})
    got = translate.translate_with_engine(rows, good, "uk", "en").collect()
    assert {(r.text, r.translations[0].text) for r in got} == {("a", "A"), ("b", "B"), (None, None)}
    assert len(got) == 4 and seen.value == 2
    got = translate.translate_with_engine(rows, broken, "uk", "en", tries=2, pause=0).collect()
    assert {(r.text, r.translations[0].text) for r in got} == {("a", "a"), ("b", "b"), (None, None)}


def test_anonymize_text_or_translation(make):
    rows = make({"text": "a@b.org", "translations": [("c@d.org", "uk", "en")]}, {"text": "a@b.org"})
    got = {r.id_: (r.text, [t.text for t in r.translations]) for r in anonymize.anonymize(rows, "en").collect()}
    assert got == {"0": ("a@b.org", ["[email]"]), "1": ("[email]", [])}
    assert {r.text for r in anonymize.anonymize(rows).collect()} == {"[email]"}


def test_anonymize_engine(make):
    def setup():
        return lambda texts: pd.DataFrame({"text": texts.str.replace("John", "[name]")})

    got = anonymize.anonymize_with_engine(make({"text": "I am John"}, {"text": ""}), setup).collect()
    assert {r.text for r in got} == {"I am [name]", ""}


def gazetteer(spark):
    rows = [(1, "Kyiv ", 30.5, 50.4), (2, "kyivska", 31.0, 50.0), (3, "lviv", 24.0, 49.8), (4, None, 0.0, 0.0), (5, "", 0.0, 0.0)]
    return spark.createDataFrame(rows, "loc_id int, name string, lon double, lat double")


def test_geo_text(make, spark):
    rows = make({"text": "In Kyiv, near kyivska", "group": None}, {"text": "nowhere"}, {"text": None})
    for forced in (False, True):
        got = geo.match_place_names(rows, gazetteer(spark), ["name"], force_shuffle=forced)
        assert {(r.id_, r.name) for r in got.collect()} == {("0", "kyiv"), ("0", "kyivska")}


def squares(spark):
    def square(x, size):
        return [(x, 0.0), (x + size, 0.0), (x + size, size), (x, size)]

    rows = [(1, "a", square(0.0, 10.0)), (2, "b", square(5.0, 10.0)), (3, "far", square(100.0, 1.0))]
    return spark.createDataFrame(rows, "region_id int, name string, ring array<struct<x:double,y:double>>")


def test_geo_point_in_overlapping_regions(make, spark):
    rows = make({"lon": 7.0, "lat": 5.0}, {"lon": 1.0, "lat": 1.0}, {"lon": -1.0, "lat": 1.0}, {})
    for forced in (False, True):
        got = geo.match_regions(rows, squares(spark), force_grid=forced)
        assert {(r.id_, r.name, r.lon) for r in got.collect()} == {("0", "a", 7.0), ("0", "b", 7.0), ("1", "a", 1.0)}


def test_shared_edge_belongs_to_one_region(make, spark):
    ring = "region_id int, name string, ring array<struct<x:double,y:double>>"
    left = [(0.0, 0.0), (5.0, 0.0), (5.0, 5.0), (0.0, 5.0)]
    right = [(5.0, 0.0), (10.0, 0.0), (10.0, 5.0), (5.0, 5.0)]
    regions = spark.createDataFrame([(1, "l", left), (2, "r", right)], ring)
    got = geo.match_regions(make({"lon": 5.0, "lat": 2.0}), regions).collect()
    assert [r.name for r in got] == ["r"]


def test_geolocate_by_point_else_by_name_on_both_paths(make, spark, monkeypatch):
    rows = make({"text": "lviv", "lon": 7.0, "lat": 5.0}, {"text": "Lviv and Kyiv"}, {"text": "none", "group": None})
    wanted = {"0": ["a", "b"], "1": ["kyiv", "lviv"], "2": []}
    for limit in (200, 0):
        monkeypatch.setattr(geo, "MAX_INLINE_NAMES", limit)
        got = geo.geolocate(rows, gazetteer(spark), ["name"], squares(spark)).collect()
        assert {r.id_: [x.name for x in r.info.locations] for r in got} == wanted


def test_contains_join_equals_brute_force(spark, monkeypatch):
    import random

    from feedlens.operators import contains

    rng = random.Random(7)
    texts = [(i, "".join(rng.choice("abcß ") for _ in range(rng.randint(0, 60)))) for i in range(60)]
    phrases = [(i, "".join(rng.choice("abcß ") for _ in range(rng.randint(1, 12)))) for i in range(40)] + [(99, ""), (98, None)]
    wanted = {(i, j) for i, t in texts for j, p in phrases if p and p in t}
    t = spark.createDataFrame(texts, "id int, t string")
    p = spark.createDataFrame(phrases, "pid int, p string")
    for forced, bound in ((False, 64), (True, 1 << 20), (True, 64)):
        monkeypatch.setattr(contains, "TABLE_BITS", bound)
        got = [(r.id, r.pid) for r in contains_join(t, "t", p, "p", forced).collect()]
        assert len(got) == len(set(got)) and set(got) == wanted


def test_stages_run_in_fixed_order(make):
    def mark(name):
        return lambda df: df.withColumn("text", F.concat("text", F.lit(name)))

    done = enrich(make({"text": ""}), anonymize=mark("4"), geolocate=mark("3"), classify=mark("2"), translate=mark("1"))
    assert done.first().text == "1234"
    with pytest.raises(ValueError, match="unknown stage"):
        Pipeline(store=None, stages={"polish": mark("x")})


def test_long_tables_give_the_same_as_short_ones_on_equal_keys(spark, make):
    texts = ["a und b", "c und d", "", None, "the und water pipe clean water clean water", "THE it's fine", "a und b"]
    rows = make(*({"id_": None if i % 2 else "same", "group": None, "text": t} for i, t in enumerate(texts)))
    stop = spark.createDataFrame([("de", "und"), ("en", "the"), ("en", "it's")], "lang string, word string")
    terms = spark.createDataFrame(
        [("w", "clean water"), ("w", "und"), ("v", "It's"), ("v", "water pipe"), ("v", "?")], "label string, term string")
    words = spark.createDataFrame([("de", "en", "und", "and"), ("de", "en", "c", "see")],
                                  "from_lang string, to_lang string, word string, translation string")
    keys = spark.createDataFrame([("water pipe",), ("und",), (" ",), ("it's fine",)], "keyword string")
    places = spark.createDataFrame([(1, "b", 1.0, 2.0), (2, "water", 3.0, 4.0)], "loc_id int, name string, lon double, lat double")

    def collected(df, *columns):
        return sorted(map(repr, df.select("text", *columns).collect()))

    from feedlens.operators.keywords import keyword_flag
    from feedlens.operators.language import detect_language

    for short, long, columns in (
        (*(detect_language(rows, stop, max_inline=n) for n in (500, 0)), ["detected_lang"]),
        (*(classify.classify_labels(rows, terms, ["w", "v"], max_inline=n) for n in (500, 0)), ["classifications"]),
        (*(translate.translate_with_lexicon(rows, words, "de", "en", max_inline=n) for n in (500, 0)), ["translations"]),
        (*(keyword_flag(rows, keys, max_inline=n) for n in (500, 0)), ["keyword_flag"]),
        (*(geo.geolocate(rows, places, ["name"], force_shuffle=f) for f in (False, True)), ["info.locations"]),
    ):
        assert collected(short, *columns) == collected(long, *columns)
    scores = classify.classify_labels(rows.where("text like '%pipe%'"), terms, ["w", "v"]).first()["classifications"]
    assert [c["score"] for c in scores] == [1.0, 0.5]


def test_a_bad_text_fails_alone(make):
    import pandas as pd

    def setup(source, target):
        def run(texts: pd.Series) -> pd.DataFrame:
            if (texts == "bad").any():
                raise ValueError("refused")
            return pd.DataFrame({"text": texts.str.upper()})

        return run

    rows = make(*({"id_": str(i), "text": t} for i, t in enumerate([*map(str, range(40)), "bad", "", "bad"])))
    got = translate.translate_with_engine(rows, setup, "de", "en", tries=2, pause=0.0, failed="failed").collect()
    assert {r.text for r in got if r.failed} == {"bad"} and sum(r.failed for r in got) == 2
    assert all(r.translations[0].text == r.text.upper() for r in got if r.text and not r.failed)


def test_names_are_redacted_as_whole_words(make, spark):
    names = spark.createDataFrame([("Anna",), ("Anna Maria",), ("O.K.",), ("ÉLISE",), ("",), (None,)], "name string")
    rows = make(*({"id_": str(i), "text": t} for i, t in enumerate(
        ["ANNA met Annabel and anna maria.", "élise, O.K. or oxks", "", None, "nobody", "ANNA met Annabel and anna maria."])))
    got = {r.id_: r.text for r in anonymize.redact_names(rows, names).collect()}
    assert got == {"0": "[name] met Annabel and [name].", "1": "[name], [name] or oxks", "2": "", "3": None,
                   "4": "nobody", "5": "[name] met Annabel and [name]."}


def test_defaults_are_wired(make):
    from feedlens.operators.keywords import keyword_flag
    from feedlens.operators.language import detect_language

    rows = make({"id_": "0", "text": "the water is not here"}, {"id_": "1", "text": "das Wasser ist nicht hier"}, {"id_": "2", "text": "IFRC"})
    assert {r.id_: r.detected_lang for r in detect_language(rows).collect()} == {"0": "en", "1": "de", "2": None}
    assert {r.id_ for r in keyword_flag(rows).collect() if r.keyword_flag} == {"2"}
