r"""Text expressions.

Python's ``\w`` is letters, digits and underscore without combining marks, and
its ``\s`` is the full Unicode set; both are spelled out here as classes so the
result does not hang on a regex flag of the engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Python counts as white space.
WHITESPACE = (
    r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WORD = r"\p{L}\p{N}_"

# Code-point blocks that hold pictographs.
EMOJI = (
    r"[\x{1F1E6}-\x{1F1FF}\x{1F300}-\x{1F64F}\x{1F680}-\x{1F6FF}\x{1F700}-\x{1FAFF}"
    r"\x{2600}-\x{27BF}\x{2B50}\x{2B55}\x{FE0F}\x{200D}\x{20E3}]"
)
URL = rf"(https?://|www\.)[^{WHITESPACE}<>\"]+"


def strip(text: Column) -> Column:
    """Trim every Unicode white-space character, not only blanks."""
    return F.regexp_replace(text, rf"^[{WHITESPACE}]+|[{WHITESPACE}]+$", "")


def fold(text: Column) -> Column:
    """Lower-cased and stripped: the form in which names are matched."""
    return strip(F.lower(text))


def strip_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, rf"[^{WORD}{WHITESPACE}]", "")


def words(text: Column) -> Column:
    """Lower-cased words without punctuation, in text order."""
    split = F.split(strip_punctuation(F.lower(text)), rf"[{WHITESPACE}]+")
    return F.array_remove(split, "")


def listed_words(text: Column, wanted: list[str]) -> Column:
    """Those of ``words(text)`` that are in the list (a hash set once it is long)."""
    return F.filter(words(text), lambda w: w.isin(wanted))


def is_numeric(word: Column) -> Column:
    return word.rlike(r"^\p{N}+$")


def drop_trailing_dot(word: Column) -> Column:
    return F.regexp_replace(word, r"\.$", "")


def long_enough(text: Column, minimum: int = 20) -> Column:
    """Length in code points."""
    return F.length(text) >= minimum


def has_text(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def quote_regex(keyword: str) -> str:
    """The keyword with every regex metacharacter escaped."""
    return "".join("\\" + ch if ch in r"\.[]{}()*+-?^$|&~#" else ch for ch in keyword)


def whole_word_pattern(alternatives: list[str]) -> str:
    """One pattern that finds any of the (lower-cased) words on word bounds."""
    joined = "|".join(quote_regex(word) for word in alternatives)
    return rf"(^|[^{WORD}])({joined})($|[^{WORD}])"


def clean_text(text: Column) -> Column:
    """One line, URLs replaced, pictographs removed, case kept."""
    has_url = F.contains(text, F.lit("://")) | F.contains(text, F.lit("www."))
    out = F.when(has_url, F.regexp_replace(text, URL, "<URL>")).otherwise(text)
    out = F.regexp_replace(out, EMOJI, "")
    # a line break is white space like any other: each run becomes one blank
    return F.trim(F.regexp_replace(out, rf"[{WHITESPACE}]+", " "))


def dataset_name(country: Column, start: Column, end: Column) -> Column:
    day = "yyyy-MM-dd"
    return F.concat_ws("-", country, F.date_format(start, day), F.date_format(end, day))
