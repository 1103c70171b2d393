"""Text rules as Column expressions; all stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from themeloom.functions import fixed


_BLANKS = " " * len(fixed.WHITESPACE_CHARS)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_length(review) -> Column:
    """Length in code points; a missing review counts as empty."""
    return F.length(F.coalesce(_col(review), F.lit("")))


def long_enough(review, min_len: int) -> Column:
    """Minimum-length predicate on the raw review; 0 switches it off."""
    return text_length(review) >= min_len if min_len > 0 else F.lit(True)


def normalise(review) -> Column:
    """One line, whitespace runs collapsed to a blank, no blank at either end."""
    text = F.coalesce(_col(review), F.lit(""))
    return F.trim(F.regexp_replace(F.translate(text, fixed.WHITESPACE_CHARS, _BLANKS), " {2,}", " "))


def entry(name, rating, review_norm) -> Column:
    """``[ID:..] [rating:..] text`` for an already normalised review."""
    return F.concat(
        F.lit("[ID:"), F.coalesce(_col(name), F.lit("")),
        F.lit("] [rating:"), F.coalesce(_col(rating).cast("string"), F.lit("")),
        F.lit("] "), _col(review_norm),
    )


def strip_outer_punctuation(quote) -> Column:
    """Remove punctuation and whitespace from both ends; keep what is inside."""
    return F.trim(_col(quote), F.lit(fixed.OUTER_PUNCTUATION))


def strip_blank(text) -> Column:
    """Remove whitespace, line ends included, from both ends of a text."""
    return F.trim(_col(text), F.lit(fixed.WHITESPACE_CHARS))


def is_placeholder(content) -> Column:
    """A knowledge layer that is empty or still carries a template marker."""
    body = F.coalesce(_col(content), F.lit(""))
    hit = strip_blank(body) == ""
    for marker in fixed.PLACEHOLDER_MARKERS:
        hit = hit | body.contains(marker)
    return hit


def coding_file_name(path) -> Column:
    """The ``batch_...csv`` part of a path: a file, or a folder of parts named like one."""
    plain = F.url_decode(F.replace(_col(path), F.lit("+"), F.lit("%2B")))  # a path's plus is no blank
    return F.regexp_extract(plain, r"(?:^|[/=])(batch_[^/]*\.csv)(?:/[^/]*)?$", 1)


def file_batch_id(file_name) -> Column:
    """Batch number of a coding file, NULL when the name does not follow the pattern."""
    digits = F.regexp_extract(_col(file_name), fixed.CODING_FILE_PATTERN, 1)
    return digits.try_cast("bigint")


def file_theme(file_name) -> Column:
    """Theme of a coding file, NULL when the name carries none."""
    theme = F.regexp_extract(_col(file_name), fixed.CODING_FILE_PATTERN, 2)
    return F.when(theme != "", theme)


def has_entry_marks(quote) -> Column:
    return _col(quote).contains("[ID:") | _col(quote).contains("[rating:")


def has_ellipsis(quote) -> Column:
    return _col(quote).contains("…") | _col(quote).contains("...")


def code_too_long(code) -> Column:
    return F.length(_col(code)) > fixed.CODE_NAME_CHARS


def ngrams(text, n: int) -> Column:
    """All overlapping n-grams of a text. A look-ahead walks the text once, where ``substr`` at
    every position would rescan it from the start."""
    return F.regexp_extract_all(_col(text), F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))
