"""Redaction of personal data as a chain of native regex replacements."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# kind -> (pattern, replacement); applied in this order, so that a longer digit
# run is taken for a card before parts of it can pass for a phone number. Only
# syntax common to java.util.regex and RE2 is used (no look-around).
RULES: dict[str, tuple[str, str]] = {
    "url": (r"(https?://|www\.)[^ \t\r\n<>\"]+", "[url]"),
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[email]"),
    "secret": (
        r"((?i:api_key|apikey|token|secret|password|passwd))[ ]*[=:][ ]*(\"[^\"\r\n]+\"|[^ \t\r\n\"]+)",
        "$1 = [secret]",
    ),
    "ip": (r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}", "[ip]"),
    "card": (r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{1,7}", "[card]"),
    "phone": (r"\+[0-9]{1,3}[ ]?(\([0-9]{1,4}\)[ ]?)?[0-9]{2,4}([ -]?[0-9]{2,4}){1,3}", "[phone]"),
}
KINDS = list(RULES)

# A match of the kind holds one of these; a text with none is passed over by a
# byte search instead of a regex scan.
SIGNS: dict[str, list[str]] = {
    "url": ["://", "www."],
    "email": ["@"],
    "secret": ["=", ":"],
}


def redact(text: Column, kinds: list[str] | None = None) -> Column:
    """The text with every match replaced by a typed placeholder; null stays null."""
    out = text
    for kind in RULES if kinds is None else [k for k in RULES if k in kinds]:
        pattern, replacement = RULES[kind]
        replaced = F.regexp_replace(out, pattern, replacement)
        if kind in SIGNS:
            has_sign = reduce(Column.__or__, [F.contains(text, F.lit(sign)) for sign in SIGNS[kind]])
            replaced = F.when(has_sign, replaced).otherwise(out)
        out = replaced
    return out


def placeholder_count(text: Column, kind: str) -> Column:
    """How many placeholders of one kind a redacted text holds."""
    return F.coalesce(F.regexp_count(text, F.lit(rf"\[{kind}\]")), F.lit(0)).cast("bigint")
