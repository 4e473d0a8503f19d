"""Word pieces without Python workers: greedy longest match as joins over the distinct words of a corpus.

``tokens.tokenise`` matches pieces in an Arrow function and moves nothing. Here every step is a DataFrame operation:
distinct chunks, their words, the longest piece at each position of a word by an equi join with the
vocabulary, the chain of pieces from the first position, and the ids joined back to the places of the chunks.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.pieces import words_of
from ..session import staged
from .lookup import lookup_join, lookup_terms
from .tokens import SPECIAL_PIECES, with_masks

# Characters that are dropped before a text is split, and white space in Java's notation.
_CONTROLS = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}\x{fffd}]+"
_SPACE = r"(?U)\s+"


def chunks_of(text: Column) -> Column:
    """The pieces of a text between white space; special pieces stand alone. White space at an end leaves an empty chunk there."""
    specials = "|".join(p.replace("[", r"\[").replace("]", r"\]") for p in SPECIAL_PIECES)
    clean = F.regexp_replace(F.coalesce(text, F.lit("")), _CONTROLS, "")
    return F.split(F.regexp_replace(F.regexp_replace(clean, f"({specials})", " $1 "), _SPACE, " "), " ")


def _characters(text: Column) -> Column:
    return F.split(text, "")


def folded_characters(chunks: DataFrame) -> DataFrame:
    """``(ch, plain)`` for the characters beyond ASCII in ``chunks``: without accents, apart where they stand alone,
    empty where they are dropped.

    Unicode bounds their number; what each becomes is a rule of the driver's character tables.
    """
    wide = chunks.where(~F.col("chunk").rlike(r"^[\x00-\x7f]*$")).select(F.explode(F.array_distinct(_characters(F.lower("chunk")))).alias("ch"))
    found = wide.where(F.col("ch").rlike(r"[^\x00-\x7f]")).distinct().collect()

    def plain(ch: str) -> str:
        out = []
        for part in unicodedata.normalize("NFD", ch):
            if unicodedata.category(part) != "Mn":
                words = words_of(part)
                alone = words == [part] and words_of(f"a{part}a") != [f"a{part}a"]
                out.append(f" {part} " if alone else "".join(words))
        return "".join(out)

    rows = [(r["ch"], plain(r["ch"])) for r in found]
    return chunks.sparkSession.createDataFrame(rows, "ch string, plain string")


def chunk_words(chunks: DataFrame) -> DataFrame:
    """``(chunk, part, word)``: lower-case words of each distinct chunk, accents off, punctuation apart."""
    narrow = F.col("chunk").rlike(r"^[\x00-\x7f]*$")
    ascii_ = chunks.where(narrow).select("chunk", F.lower("chunk").alias("plain"))
    placed = chunks.where(~narrow).select("chunk", F.posexplode(_characters(F.lower("chunk"))).alias("at", "ch"))
    # A character that is not in the table stands for itself.
    folded = placed.join(folded_characters(chunks), "ch", "left").select("chunk", "at", F.coalesce("plain", "ch").alias("plain"))
    spelled = F.array_join(F.sort_array(F.collect_list(F.struct("at", "plain"))).getField("plain"), "")
    plain = ascii_.unionByName(folded.groupBy("chunk").agg(spelled.alias("plain")))
    apart = F.split(F.regexp_replace("plain", r"([!-/:-@\[-`{-~])", " $1 "), " +")
    return plain.select("chunk", F.posexplode(F.filter(apart, lambda w: w != "")).alias("part", "word"))


def word_pieces(words: DataFrame, vocab: DataFrame, *, unknown: int, longest: int) -> DataFrame:
    """``(word, ids)`` for distinct ``word``: pieces by greedy longest match from the left, or the unknown id.

    The longest piece that starts at a position does not depend on the pieces before it, so all
    positions are matched by one join, and the chain from the first one is followed inside the row.
    """
    placed = words.select("word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("at"))
    ends = F.sequence(F.lit(1), F.least(F.lit(longest), F.length("word") - F.col("at") + 1))
    spans = placed.select("word", "at", F.explode(ends).alias("n"))
    piece = F.concat(F.when(F.col("at") == 1, "").otherwise("##"), F.expr("substring(word, at, n)"))
    matched = lookup_join(spans.withColumn("piece", piece), vocab.select("piece", "id"), "piece", "inner")
    best = matched.groupBy("word", "at").agg(F.max(F.struct("n", "id")).alias("b"))
    tables = best.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("at", "b"))).alias("_at"))
    step = F.aggregate(
        F.sequence(F.lit(1), F.length("word")),
        F.struct(F.lit(1).alias("next"), F.array().cast("array<int>").alias("ids")),
        lambda done, at: F.when(
            # A position that no chain reaches is passed over; one without a piece ends the chain for good.
            (done["next"] == at) & F.col("_at")[at].isNotNull(),
            F.struct((done["next"] + F.col("_at")[at]["n"]).alias("next"), F.concat(done["ids"], F.array(F.col("_at")[at]["id"])).alias("ids")),
        ).otherwise(done),
    )
    whole = tables.withColumn("_c", step).where(F.col("_c.next") == F.length("word") + 1).select("word", F.col("_c.ids").alias("ids"))
    return words.join(whole, "word", "left").select("word", F.coalesce("ids", F.array(F.lit(unknown))).alias("ids"))


def chunk_pieces(chunks: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(chunk, ids)`` for distinct ``chunk``; ``vocab`` is ``(piece, id)``. A chunk without a word has no ids."""
    marks = vocab.agg(F.max(F.when(F.col("piece") == "[UNK]", F.col("id"))).alias("unknown"), F.max(F.length("piece")).alias("longest")).first()
    special = chunks.where(F.col("chunk").isin(SPECIAL_PIECES)).join(vocab, chunks["chunk"] == vocab["piece"]).select("chunk", F.array("id").alias("ids"))
    words = staged(chunk_words(chunks.where(~F.col("chunk").isin(SPECIAL_PIECES))), "chunk_words")
    pieces = word_pieces(words.select("word").distinct(), vocab, unknown=marks["unknown"], longest=marks["longest"])
    found = lookup_join(words, pieces, "word", "inner")
    ordered = F.sort_array(F.collect_list(F.struct("part", "ids"))).getField("ids")
    return found.groupBy("chunk").agg(F.flatten(ordered).alias("ids")).unionByName(special)


def tokenise_native(
    df: DataFrame, vocab: DataFrame, key: str, text: str = "text", *, max_length: int | None = None, pad: bool = False
) -> DataFrame:
    """``key`` and the four token arrays of ``tokens.tokenise``, without a Python worker.

    ``key`` must tell the rows apart, ``vocab`` is ``(piece, id)``. Distinct chunks are counted before they move; texts
    move once, into slices, and the places of chunks not at all.
    """
    table = {r["piece"]: r["id"] for r in vocab.where(F.col("piece").isin(SPECIAL_PIECES)).collect()}
    # The outer form keeps Spark from deriving a filter that splits the texts again; an empty chunk has no piece.
    chunks = df.select(F.explode_outer(chunks_of(F.col(text))).alias("chunk")).distinct()
    ids = staged(chunk_pieces(staged(chunks, "chunks"), vocab), "chunk_ids")
    # Rows without a piece come back with empty arrays.
    found = lookup_terms(df.select(key, text), key, chunks_of(F.col(text)), ids.where(F.size("ids") > 0), "chunk", "ids", how="left")
    rows = found.select(key, F.flatten("values").alias("_pieces"))
    return with_masks(rows, "_pieces", cls=table["[CLS]"], sep=table["[SEP]"], pad_id=table["[PAD]"], max_length=max_length, pad=pad).drop("_pieces")
