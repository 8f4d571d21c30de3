"""Column helpers shared by the operators that stay within DataFrame functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word: a run of characters other than space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once, also where ``body`` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def count_of(text: Column, characters: str) -> Column:
    """Number of characters of ``text`` that are among ``characters``."""
    return (F.char_length(text) - F.char_length(F.translate(text, characters, ""))).cast("long")


def fraction_text(doc_id: Column) -> Column:
    """crc32 of the id as text; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
