"""String columns: markup, joins, sentence cuts, names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Marks that end a sentence.
SENTENCE_MARKS = ".!?"


def strip_markup(text: Column) -> Column:
    """Drop inline tags such as ``<i>`` and keep the text between them."""
    return F.regexp_replace(text, "</?[A-Za-z][^<>]*>", "")


def join_text(first: Column, *rest: Column, delimiter: str = " ") -> Column:
    """Join text columns; null in any of them gives null rather than a shorter text."""
    parts = [first]
    for column in rest:
        parts += [F.lit(delimiter), column]
    return F.concat(*parts)


def slice_text(text: Column, begin: Column, end: Column) -> Column:
    """Characters ``begin`` (inclusive) to ``end`` (exclusive), 0-based; empty if none."""
    return F.substring(text, begin + 1, F.greatest(end - begin, F.lit(0)))


def _first_mark(text: Column) -> Column:
    """1-based position of the first sentence mark in ``text``, 0 if there is none."""
    head, *others = SENTENCE_MARKS
    return F.locate(head, F.translate(text, "".join(others), head * len(others)))


def sentence_begin(text: Column, index: Column) -> Column:
    """Start of the sentence around character ``index``: one past the last mark at
    a position in ``1..index``, or 0. Position 0 is never taken as a mark."""
    found = _first_mark(F.reverse(F.substring(text, F.lit(2), index)))
    return F.when(found > 0, index - found + 2).otherwise(0)


def sentence_end(text: Column, index: Column, *, keep_last: bool = False) -> Column:
    """Exclusive end of the sentence: the first mark at or after ``index``.

    Without a mark the end is ``length - 1``, which leaves the last character
    out; ``keep_last=True`` keeps it.
    """
    found = _first_mark(F.substring(text, index + 1, F.length(text)))
    last = F.length(text) if keep_last else F.length(text) - 1
    return F.when(found > 0, index + found - 1).otherwise(last)


def metric_name(name: Column) -> Column:
    """Metric key without the markers ``predict_`` and ``overall_``."""
    return F.replace(F.replace(name, F.lit("predict_"), F.lit("")), F.lit("overall_"), F.lit(""))
