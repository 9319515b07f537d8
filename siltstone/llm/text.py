"""Word-level building blocks from built-in functions, shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The blanks of the word pattern [^\x20\x09-\x0D]+ beside the space itself.
BLANKS = ("\t", "\n", "\x0b", "\x0c", "\r")
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once: a lambda argument is not expanded into its uses."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blanks_to_spaces(text: Column) -> Column:
    """Every blank as a space, ends trimmed.  ``replace`` searches bytes, far cheaper than a pattern over characters."""
    out = text
    for blank in BLANKS:
        out = F.replace(out, F.lit(blank), F.lit(" "))
    return F.trim(out)


def single_spaces(text: Column) -> Column:
    """Runs of spaces as one; the pattern only works on texts that have a run.  Use it in a projection of its own."""
    return F.when(text.contains("  "), F.regexp_replace(text, " {2,}", " ")).otherwise(text)


def words_of(spaced_text: Column) -> Column:
    """The words of a text with single spaces; an empty one has none."""
    return F.when(spaced_text == "", F.array().cast("array<string>")).otherwise(F.split(spaced_text, " "))


def word_count(spaced_text: Column) -> Column:
    """Number of words of a text with single spaces, counted by the bytes that removing the spaces saves."""
    gaps = F.octet_length(spaced_text) - F.octet_length(F.replace(spaced_text, F.lit(" "), F.lit("")))
    return F.when(spaced_text == "", F.lit(0)).otherwise(gaps + 1).cast("long")


def occurrences(text: Column, char: str) -> Column:
    """How often one ASCII character occurs."""
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(char), F.lit("")))).cast("long")
