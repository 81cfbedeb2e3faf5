"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Text in the model can never hold NUL, so it marks the places found below.
_MARK = "\u0000"
_WORD_MARK = _MARK + " "

# Letters without a one-letter capital, which stay as they are.
_NO_CAPITAL = "ßŉǰΐΰևẖẗẘẙẚὐὒὔὖᾲᾴᾶᾷῂῄῆῇῒΐῖῗῢΰῤῦῧῲῴῶῷﬀﬁﬂﬃﬄﬅﬆﬓﬔﬕﬖﬗ"


def blank_to_null(text: Column) -> Column:
    """Text without surrounding blanks (U+0020 only); NULL when nothing is left."""
    return F.nullif(F.trim(text), F.lit(""))


def title_case(text: Column) -> Column:
    """Capitalise each run of letters and digits, lower-case the rest.

    ``F.initcap`` alone starts words only after a space; here ``d'oeste`` and
    ``embu-guacu`` hold two words each. A marked space goes in after every other
    separator for ``F.initcap`` to find, and comes out again. No lambda, so the
    projection stays in whole-stage codegen.
    """
    words = F.regexp_replace(text, r"([^\p{L}\p{N}])(?=[\p{L}\p{N}])", "$1" + _WORD_MARK)
    # A mark in front of a word's first letter keeps it from being expanded (ß to Ss).
    kept = rf"([{_NO_CAPITAL}])(?<![\p{{L}}\p{{N}}].)"
    titled = F.initcap(F.regexp_replace(words, kept, _MARK + "$1"))
    return F.replace(F.replace(titled, F.lit(_WORD_MARK), F.lit("")), F.lit(_MARK), F.lit(""))


def category_label(text: Column) -> Column:
    """``" cool_stuff "`` → ``"Cool Stuff"``."""
    return title_case(F.replace(F.trim(text), F.lit("_"), F.lit(" ")))


def region_code(text: Column) -> Column:
    return F.upper(F.trim(text))
