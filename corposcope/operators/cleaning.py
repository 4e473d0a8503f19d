"""Article clean-up: typed defaults, repeated elements, validity, text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keys import uniform
from ..functions.text import join_text, strip_markup

LANGUAGE = "eng"


def _int_or_zero(leaf: str) -> Column:
    return F.coalesce(F.trim(leaf).try_cast("int"), F.lit(0))


def _text_or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _repeated(leaf: str, mode: str) -> Column:
    """An element that may occur several times: its first value, or all joined by a space."""
    if mode == "first":
        return F.get(F.col(leaf), F.lit(0))
    if mode == "join":
        return F.array_join(leaf, " ")
    raise ValueError("mode must be 'first' or 'join'")


def with_defaults(articles: DataFrame, *, repeats: str = "first", markup: str = "keep") -> DataFrame:
    """Flatten scanned articles: ints default to 0, strings to empty.

    Values of the wrong type are ignored, which leaves the default. Columns the
    scan added beside the article (file name and the like) are kept.
    """
    if markup not in ("keep", "strip"):
        raise ValueError("markup must be 'keep' or 'strip'")
    clean = strip_markup if markup == "strip" else (lambda text: text)
    cit, art = "MedlineCitation", "MedlineCitation.Article"
    extra = [c for c in articles.columns if c != cit]
    return articles.select(
        _int_or_zero(f"{cit}.PMID").alias("id"),
        _int_or_zero(f"{cit}.DateCompleted.Year").alias("year"),
        _int_or_zero(f"{cit}.DateCompleted.Month").alias("month"),
        _int_or_zero(f"{cit}.DateCompleted.Day").alias("day"),
        _text_or_empty(F.trim(f"{art}.Journal.ISSN")).alias("issn"),
        clean(_text_or_empty(_repeated(f"{art}.Abstract.AbstractText", repeats))).alias("abstract"),
        clean(_text_or_empty(F.col(f"{art}.ArticleTitle"))).alias("title"),
        _text_or_empty(F.trim(_repeated(f"{art}.Language", "first"))).alias("language"),
        *extra,
    )


def valid_articles(df: DataFrame, language: str = LANGUAGE) -> DataFrame:
    """Articles with an abstract and an ISSN, in the wanted language."""
    return df.where(
        (F.col("abstract") != "") & (F.col("issn") != "") & (F.col("language") == language)
    )


def article_text(title: str = "title", abstract: str = "abstract") -> Column:
    return join_text(F.col(title), F.col(abstract), delimiter="\n")


def normal_issn(issn: Column) -> Column:
    return F.translate(issn, "-", "")


def with_random_key(df: DataFrame, key: str = "id", seed: int = 0) -> DataFrame:
    """Add ``random``, a seeded uniform number per row for the random baseline."""
    return df.withColumn("random", uniform(key, seed=seed))
