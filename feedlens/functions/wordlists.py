"""Fixed values, plus stop words taken from Spark's own lists."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, SparkSession

from feedlens.session import lookup_table

# Default keywords of the organisation-mention flag.
DEFAULT_KEYWORDS = [
    "червоний хрест", "червоного хреста", "червоному хресту", "червоним хрестом",
    "червоному хресті", "бчх", "красный крест", "красному кресту", "красного креста",
    "красным крестом", "красном кресте", "крест", "кресту", "крестом", "кресте",
    "Хреста", "Хрест", "хрестом", "хресту", "хресті", "КК", "ЧХ", "МКЧХ", "МФОКК",
    "МККК", "МФОККиКП", "МФЧХ", "IFRC",
]

# Language codes and the names under which Spark ships stop words.
STOPWORD_LANGUAGES = {
    "da": "danish", "de": "german", "en": "english", "es": "spanish", "fi": "finnish",
    "fr": "french", "hu": "hungarian", "it": "italian", "nl": "dutch", "no": "norwegian",
    "pt": "portuguese", "ru": "russian", "sv": "swedish", "tr": "turkish",
}


def stopword_table(spark: SparkSession, langs: list[str]) -> DataFrame:
    """``(lang, word)`` rows for the languages asked for."""
    unknown = [lang for lang in langs if lang not in STOPWORD_LANGUAGES]
    if unknown:
        raise ValueError(f"no stop words for {', '.join(unknown)}; pass a table instead")
    rows = [
        (lang, word)
        for lang in langs
        for word in StopWordsRemover.loadDefaultStopWords(STOPWORD_LANGUAGES[lang])
    ]
    return lookup_table(spark, rows, "lang string, word string")
