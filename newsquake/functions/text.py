"""Headline filters and text extraction as column expressions."""

from __future__ import annotations

import json
import re
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsquake import constants as K

# Java reads \b, \w and case folding as ASCII unless told otherwise, and ends lines for `.` at more than \n.
_IGNORE_CASE = "(?iUd)"


def _nfkd_without_marks():
    """Arrow UDF; defined inside a function so that it travels to workers by value."""

    def folded(text: pd.Series) -> pd.Series:
        def fold(value):
            if value is None or value.isascii():
                return value
            return "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))

        return text.map(fold, na_action="ignore")

    return F.pandas_udf(folded, T.StringType())


def normalize_for_match(text: Column) -> Column:
    """Accents folded, lower case, '.' and ',' dropped, blanks collapsed.

    ASCII texts stay in the JVM; only the others go through the complete NFKD decomposition, an Arrow UDF.
    """
    ascii_only = text.rlike(r"^\p{ASCII}*$")
    folded = F.when(ascii_only, text).otherwise(_nfkd_without_marks()(F.when(~ascii_only, text)))
    bare = F.translate(F.lower(folded), ".,", "")
    return F.trim(F.regexp_replace(bare, r"(?U)\s+", " "))


def split_feed_title(feed_title: Column) -> tuple[Column, Column]:
    """(title, publisher) split at the last ' - '; the default publisher when there is none."""
    pattern = r"(?s)^(.*) - (.*)$"
    has_publisher = feed_title.contains(" - ")
    title = F.when(has_publisher, F.regexp_extract(feed_title, pattern, 1)).otherwise(feed_title)
    publisher = F.when(has_publisher, F.regexp_extract(feed_title, pattern, 2)).otherwise(K.DEFAULT_PUBLISHER)
    return title, publisher


def publisher_tokens(publisher: Column) -> Column:
    return F.regexp_extract_all(F.lower(publisher), F.lit("([a-z0-9]+)"), F.lit(1))


def _tokens(name: str) -> list[str]:
    return re.findall("[a-z0-9]+", name.lower())


def is_low_quality_publisher(publisher: Column, denied=K.LOW_QUALITY_PUBLISHERS) -> Column:
    """True when the leading tokens are a denied name, so 'tikr.com' is caught and 'Tikrit' is not."""
    starts = "|".join(sorted({" ".join(_tokens(name)) for name in denied if _tokens(name)}))
    return F.array_join(publisher_tokens(publisher), " ").rlike(f"^(?:{starts})(?: |$)")


def is_low_content(title: Column) -> Column:
    """True for headline shapes without content.

    The full pattern only runs on texts that hold one of the pieces a match must contain, and its
    Unicode word rules only on texts that are not plain ASCII.
    """
    lowered = F.lower(title)
    possible = reduce(lambda a, piece: a | lowered.contains(piece), K.LOW_CONTENT_PIECES, title.contains("\u017f"))
    plain = title.rlike("(?id)" + K.LOW_CONTENT_PATTERN)
    full = title.rlike(_IGNORE_CASE + K.LOW_CONTENT_PATTERN)
    return F.when(~possible, F.lit(False)).when(title.rlike(r"^\p{ASCII}*$"), plain).otherwise(full)


def brand_core(name: Column) -> Column:
    """Company name without legal-form words at either end."""
    words = "|".join(K.LEGAL_SUFFIX_WORDS)
    text = normalize_for_match(name)
    text = F.regexp_replace(text, rf"^(?:(?:{words})(?: |$))+", "")
    return F.regexp_replace(text, rf"(?:(?:^| )(?:{words}))+$", "")


def name_needle(name: Column) -> Column:
    """What a headline is searched for: the core, or the whole name when the core is one common word."""
    core = brand_core(name)
    specific = (core != "") & (core.contains(" ") | ~core.isin(*K.AMBIGUOUS_NAME_CORES))
    needle = F.when(specific, core).otherwise(normalize_for_match(name))
    return F.when(F.length(needle) >= K.MIN_NEEDLE_LENGTH, needle).otherwise("")


def word_pattern(literal: Column) -> Column:
    """A regex that finds the literal between word boundaries."""
    quoted = F.replace(literal, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    return F.concat(F.lit(r"(?U)\b\Q"), quoted, F.lit(r"\E\b"))


def sector_pattern(sector: str) -> str:
    """Alternation of a sector's keywords, longest first."""
    words = sorted(K.SECTOR_KEYWORDS[sector], key=lambda w: (-len(w), w))
    return r"\b(?:" + "|".join(re.escape(w) for w in words) + r")\b"


def is_relevant(
    title: Column, needle_pattern: Column, ticker_pattern: Column, keyword_pattern: Column
) -> Column:
    """Name on word boundaries, or ticker as a case-sensitive word, or a sector keyword; null patterns never match."""
    by_name = F.rlike(normalize_for_match(title), needle_pattern)
    by_ticker = F.rlike(title, ticker_pattern)
    by_sector = F.rlike(title, F.concat(F.lit(_IGNORE_CASE), keyword_pattern))
    no = F.lit(False)
    return F.coalesce(by_name, no) | F.coalesce(by_ticker, no) | F.coalesce(by_sector, no)


def parse_generated_text(text: Column) -> Column:
    """struct(reasoning, answer, reject_reason) of a 'REASONING: ... ANSWER: ...' text."""
    flags = "(?isU)"
    trimmed = F.coalesce(text, F.lit(""))

    def strip(c: Column) -> Column:
        return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")

    reasoning = strip(F.regexp_extract(trimmed, flags + r"REASONING:\s*(.*?)(?:\n\s*ANSWER:|$)", 1))
    answer = strip(F.regexp_extract(trimmed, flags + r"ANSWER:\s*(.*)", 1))
    suspicious = _IGNORE_CASE + K.SUSPICIOUS_TEXT_PATTERN
    reason = (
        F.when(reasoning == "", "no_reasoning")
        .when(
            (F.char_length(reasoning) > K.MAX_REASONING_CHARS) | (F.char_length(answer) > K.MAX_ANSWER_CHARS), "too_long"
        )
        .when(reasoning.rlike(suspicious) | answer.rlike(suspicious), "suspicious")
    )
    accepted = reason.isNull()
    return F.struct(
        F.when(accepted, reasoning).alias("reasoning"),
        F.when(accepted & (answer != ""), answer).alias("answer"),
        reason.alias("reject_reason"),
    )


# Comments, scripts and styles are one token each and count for nothing; a '>' inside quotes ends no tag.
_MARKUP = r"""(?is)<!--.*?(?:-->|$)|<(script|style)\b.*?(?:</\1\s*>|$)|</?[a-z](?:"[^"]*"|'[^']*'|[^'">]++)*+>|[^<]+|<"""


def cell_after_label(html: Column, label: str, tag: str = "td") -> Column:
    """Text of the cell that follows the first cell holding exactly the label; null when absent or the last.

    The page is cut into tags and texts, which are walked once with the cells open at that point. A cell's text is all
    text inside, each piece stripped, with that of cells nested in it; the cell that follows is the first one opened
    after the label's was closed. A cell that is never closed reaches to the end of the page.
    """
    tokens = F.regexp_extract_all(html, F.lit(_MARKUP), F.lit(0))
    cell = "struct<text: string, wanted: boolean>"
    start = F.struct(
        F.array().cast(f"array<{cell}>").alias("open"), F.lit(False).alias("found"), F.lit(False).alias("taken"), F.lit(None).cast("string").alias("answer")
    )

    def step(state: Column, token: Column) -> Column:
        top = F.try_element_at(state["open"], F.lit(-1))
        wanted = state["found"] & ~state["taken"]
        opened = F.struct(
            F.array_append(state["open"], F.struct(F.lit("").alias("text"), wanted.alias("wanted"))).alias("open"),
            state["found"].alias("found"), (state["taken"] | wanted).alias("taken"), state["answer"].alias("answer"),
        )
        closed = F.struct(
            F.slice(state["open"], 1, F.greatest(F.size(state["open"]) - 1, F.lit(0))).alias("open"),
            (state["found"] | F.coalesce(top["text"] == label, F.lit(False))).alias("found"),
            state["taken"].alias("taken"),
            F.when(F.coalesce(top["wanted"], F.lit(False)), top["text"]).otherwise(state["answer"]).alias("answer"),
        )
        plain = F.regexp_replace(token, r"(?U)^\s+|\s+$", "")
        heard = F.struct(
            F.transform(state["open"], lambda c: F.struct(F.concat(c["text"], plain).alias("text"), c["wanted"].alias("wanted"))).alias("open"),
            state["found"].alias("found"), state["taken"].alias("taken"), state["answer"].alias("answer"),
        )
        return (
            F.when(token.rlike(rf"(?i)^<{tag}(?![a-z0-9-])"), opened)
            .when(token.rlike(rf"(?i)^</{tag}(?![a-z0-9-])"), closed)
            .when(token.rlike(r"(?i)^<(?:[/a-z]|!--)"), state)
            .otherwise(heard)
        )

    def answer(state: Column) -> Column:
        unclosed = F.filter(state["open"], lambda c: c["wanted"])
        return F.coalesce(state["answer"], F.try_element_at(unclosed, F.lit(1))["text"])

    return F.aggregate(tokens, start, step, answer)


def percent_to_fraction(cell: Column) -> Column:
    """'3.15%' to 0.0315; '', '-' and text to null."""
    raw = F.regexp_replace(cell, "%+$", "")
    return F.when(~raw.isin("", "-"), raw.try_cast("double") / 100)


def field_text(text: Column, pattern: str) -> Column:
    """First match of a field pattern, null when there is none."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1))


# A JSON value that has an object at its root; nested parts are checked by the parser.
_OBJECT = r"(?s)(\{.*\})"


def outer_braces(text: Column) -> Column:
    """From the first '{' to the last '}', null when there is no such span."""
    return F.when(text.rlike(_OBJECT), F.regexp_extract(text, _OBJECT, 1))


def _strict_json():
    """Arrow UDF; defined inside a function so that it travels to workers by value."""

    def checked(text: pd.Series) -> pd.Series:
        def valid(value):
            if value is None:
                return False
            try:
                json.loads(value)
                return True
            except ValueError:
                return False

        return text.map(valid).astype("bool")

    return F.pandas_udf(checked, T.BooleanType())


def is_valid_json(text: Column) -> Column:
    """True when the outermost braces hold strict JSON.

    Spark's own parsers accept trailing text, single quotes and bare numbers like 01, so the
    verdict comes from one Arrow UDF over the sliced text.
    """
    return _strict_json()(outer_braces(text))
