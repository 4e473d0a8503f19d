"""Vocabularies, token ids, fixed-length packing and masking."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from ..functions.arrays import IGNORED, fixed_length, part_of_slimmed, slimmed
from ..functions.keys import bucket_of, hash_key
from ..functions.pieces import PieceIds
from ..functions.rows import Cutter
from ..sources.records import scan_vocabulary
from .lookup import lookup_terms
from .ordering import digits_for, running_starts, slab_rows_for, with_order_key, with_slab, with_sorted_ordinal
from .scoring import Band

# Special pieces, in id order for vocabularies built here.
SPECIAL_PIECES = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"]
# What fills the end of the last packed row, per column.
PACK_FILLS = {"input_ids": 0, "token_type_ids": 0, "attention_mask": 0, "special_tokens_mask": 1}

# A piece file is held by every task; published ones have well under a megabyte.
VOCABULARY_BYTES = 64 << 20
# Cells of the matrix of buckets by bands, of two longs each, that may be sent around.
BROADCAST_CELLS = 1 << 21


# --- vocabularies -----------------------------------------------------------


def words(text: str = "text") -> Column:
    """Lower-case words between single spaces."""
    return F.split(F.lower(text), " ")


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``(word, n)``; counts are combined before the shuffle, so a frequent word is one row per task."""
    # A split is never empty; the outer form avoids splitting again for a filter.
    return df.select(F.explode_outer(words(text)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def word_vocabulary(df: DataFrame, text: str = "text", first_id: int = len(SPECIAL_PIECES)) -> DataFrame:
    """Every word with an id by falling frequency, then alphabetically."""
    ranked = with_sorted_ordinal(word_counts(df, text), F.desc("n"), F.asc("word"), name="rank")
    return ranked.select("word", "n", (F.col("rank") + first_id).alias("word_id"))


def piece_vocabulary(words_of: DataFrame, chars_of: DataFrame, text: str = "text") -> DataFrame:
    """``(piece, id)``: special pieces, every character as a start and as a
    continuation, then the words by falling frequency.

    Stands in for a published piece table when none is at hand. ``words_of`` is a table of fixed
    size, all of whose words become pieces; ``chars_of`` is the corpus, whose characters do.
    """
    def counted(df: DataFrame) -> DataFrame:
        clean = F.regexp_replace(F.lower(text), r"([^\p{L}\p{N}])", " $1 ")
        return word_counts(df.select(clean.alias("text"))).where("word <> '' and word rlike '^\\\\S+$'")

    # The distinct characters of a row leave it, not its words.
    chars = chars_of.select(F.explode_outer(F.array_distinct(F.split(F.lower(text), ""))).alias("ch")).where("ch rlike '^\\\\S+$'").distinct()
    specials = F.array(*[F.struct(F.lit(p).alias("piece"), F.lit(i).cast("long").alias("at")) for i, p in enumerate(SPECIAL_PIECES)])
    starts = chars.select(F.col("ch").alias("piece"), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("at"))
    later = chars.select(F.concat(F.lit("##"), "ch").alias("piece"), F.lit(2).alias("kind"), F.lit(0).cast("long").alias("at"))
    frequent = counted(words_of).where(F.length("word") > 1).select(
        F.col("word").alias("piece"), F.lit(3).alias("kind"), (-F.col("n")).alias("at")
    )
    fixed = words_of.sparkSession.range(1).select(F.inline(specials)).select("piece", F.lit(0).alias("kind"), "at")
    everything = fixed.unionByName(starts).unionByName(later).unionByName(frequent)
    # The specials, two rows per character and the words of the fixed table reach this window.
    order = Window.orderBy("kind", "at", "piece")
    return everything.select("piece", (F.row_number().over(order) - 1).cast("int").alias("id"))


def write_vocabulary(vocab: DataFrame, path: str) -> None:
    """A piece table as text, one piece per line in id order; like a published one it is one file."""
    vocab.orderBy("id").select("piece").coalesce(1).write.text(path)


# --- token ids --------------------------------------------------------------


def pieces_in(spark: SparkSession, path: str) -> dict[str, int]:
    """The pieces of a vocabulary file with their line numbers; of at most ``VOCABULARY_BYTES``, as every task holds them."""
    rows = scan_vocabulary(spark, path)
    size = rows.agg(F.coalesce(F.sum(F.octet_length("piece") + 1), F.lit(0))).first()[0]
    if size > VOCABULARY_BYTES:
        raise ValueError(f"{path} has {size} bytes; join vocabularies of any size with word_ids")
    return {r["piece"]: r["id"] for r in rows.collect()}


def tokenise(
    df: DataFrame,
    vocab: str,
    text: str = "text",
    *,
    max_length: int | None = None,
    pad: bool = False,
    drop: list[str] | None = None,
) -> DataFrame:
    """Add ``input_ids``, ``token_type_ids``, ``attention_mask`` and ``special_tokens_mask``.

    ``vocab`` is the path of a piece file, one piece per line, that is read once and broadcast; files
    of one name don't mix (``word_ids`` joins a vocabulary of any size). Only the piece matching runs in Python, on Arrow
    batches and without a shuffle; the masks are array expressions.
    """
    spark = df.sparkSession
    table = pieces_in(spark, vocab)
    shipped = spark.sparkContext.broadcast(table)

    @F.arrow_udf("array<int>")
    def piece_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids_of = PieceIds(shipped.value)
        for batch in batches:
            yield ids_of(batch)

    pieces = piece_ids(F.col(text))
    return with_masks(
        df.withColumn("_pieces", pieces),
        "_pieces",
        cls=table["[CLS]"], sep=table["[SEP]"], pad_id=table["[PAD]"],
        max_length=max_length, pad=pad,
    ).drop("_pieces", *(drop or []))


def with_masks(
    df: DataFrame, pieces: str, *, cls: int, sep: int, pad_id: int = 0,
    max_length: int | None = None, pad: bool = False,
) -> DataFrame:
    """Wrap piece ids in start and end tokens and add the three parallel arrays."""
    body = F.col(pieces) if max_length is None else F.slice(pieces, 1, max_length - 2)
    zeros = F.array_repeat(F.lit(0), F.size(body))
    ids = F.concat(F.array(F.lit(cls)), body, F.array(F.lit(sep)))
    special = F.concat(F.array(F.lit(1)), zeros, F.array(F.lit(1)))
    columns = {
        "input_ids": (ids, pad_id),
        "token_type_ids": (F.array_repeat(F.lit(0), F.size(body) + 2), 0),
        "attention_mask": (F.array_repeat(F.lit(1), F.size(body) + 2), 0),
        "special_tokens_mask": (special, 1),
    }
    if pad:
        if max_length is None:
            raise ValueError("padding needs a length")
        columns = {k: (fixed_length(v, max_length, fill), fill) for k, (v, fill) in columns.items()}
    return df.withColumns({k: v for k, (v, _) in columns.items()})


def word_ids(df: DataFrame, vocab: DataFrame, key: str, text: str = "text", **join) -> DataFrame:
    """``(key, ids)``: word ids in text order, from a vocabulary of any size, by a join on the distinct words of slices."""
    return lookup_terms(df.select(key, text), key, words(text), vocab, "word", "word_id", **join).withColumnRenamed("values", "ids")


def sequence_length(requested: int | None, model_max: int) -> int:
    """Length to cut to: the request up to the model's maximum; without one at most 1024."""
    if requested is None:
        return min(model_max, 1024)
    return min(requested, model_max)


# --- packing ----------------------------------------------------------------


def pack(
    df: DataFrame,
    length: int,
    *,
    batch_size: int = 1024,
    order: str = "ordinal",
    fills: dict[str, int] = PACK_FILLS,
    within: tuple[str, ...] = (),
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Concatenate the token arrays of each batch and cut them into rows of ``length``.

    A batch is ``batch_size`` consecutive positions of ``order``; the last row
    of a batch is padded. Works on whichever of the ``fills`` columns exist.
    Arrays are cut with ``slice``, single tokens are never exploded. A caller
    whose batches lie inside existing partitions names their columns in
    ``within`` and saves the shuffle; those in ``keep`` are part of the result.
    """
    names = token_columns(df, fills)
    return _pack(slim_rows(df, names), names, length, batch_size=batch_size, order=order, fills=fills, within=within, keep=keep)


def token_columns(df: DataFrame, fills: dict[str, int]) -> list[str]:
    names = [c for c in fills if c in df.columns]
    if not names:
        raise ValueError("no token column to pack")
    return names


def slim_rows(df: DataFrame, names: list[str]) -> DataFrame:
    """The first of the arrays as it is, those beside it slimmed: sorted, moved and held is what can't be told from the ends."""
    return df.withColumns({n: slimmed(F.col(n), F.size(names[0])) for n in names[1:]})


def _pack(
    df: DataFrame, names: list[str], length: int, *, batch_size: int, order: str = "ordinal",
    fills: dict[str, int] = PACK_FILLS, within: tuple[str, ...] = (), keep: tuple[str, ...] = (),
) -> DataFrame:
    """``pack`` of slimmed rows."""
    by = [*within, "batch"]
    size = F.size(names[0])
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        df.select(*within, F.expr(f"{order} div {batch_size}").alias("batch"), order, *names)
        .withColumn("_size", size)
        .withColumn("_from", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .where("_size > 0")
        .withColumn(
            "chunk",
            F.explode(F.expr(f"sequence(_from div {length}, (_from + _size - 1) div {length})")),
        )
        .withColumn("_begin", F.greatest(F.col("chunk") * length - F.col("_from"), F.lit(0)).cast("int"))
        .withColumn(
            "_take",
            (F.least((F.col("chunk") + 1) * length - F.col("_from"), F.col("_size")) - F.col("_begin")).cast("int"),
        )
    )
    first = F.slice(names[0], F.col("_begin") + 1, F.col("_take")).alias(names[0])
    part = F.struct(order, first, *names[1:], "_size", "_begin", "_take").alias("_part")
    rows = spans.select(*by, "chunk", part).groupBy(*by, "chunk").agg(F.array_sort(F.collect_list("_part")).alias("_parts"))

    def tokens(name: str) -> Column:
        if name == names[0]:
            return F.flatten(F.col("_parts").getField(name))
        return F.flatten(F.transform("_parts", lambda p: part_of_slimmed(p[name], p["_size"], p["_begin"], p["_take"])))

    return rows.select(*keep, "batch", "chunk", *[fixed_length(tokens(n), length, fills[n]).alias(n) for n in names])


def pack_sorted(df: DataFrame, names: list[str], length: int, *, batch_size: int, slab_rows: int, fills: dict[str, int], kinds: dict[str, DataType]) -> DataFrame:
    """``batch, chunk`` and token arrays of slimmed rows whose partitions hold whole slabs in order.

    The arrays go once through an Arrow function that copies their tokens into rows; a batch never leaves a slab.
    """
    cut = Cutter(names, [fills[n] for n in names], [to_arrow_type(kinds[n].elementType) for n in names], length, batch_size, slab_rows)
    fields = ", ".join(["batch long", "chunk long", *[f"`{n}` {kinds[n].simpleString()}" for n in names]])
    return df.select("slab", *names).mapInArrow(cut, fields)


def pack_shuffled(
    df: DataFrame,
    key: str,
    length: int,
    *,
    batch_size: int = 1024,
    seed: int = 42,
    digits: int | None = None,
    fills: dict[str, int] = PACK_FILLS,
) -> DataFrame:
    """Seeded shuffle and packing with a single shuffle of the token arrays.

    The arrays move to their slab, a run of whole batches whose first keys are found on the keys alone, are sorted
    there and cut as they come: nothing straddles two slabs, and a task holds a few rows besides the sort.
    ``df`` is read four times for its keys and once for its arrays, so pass a stored table.
    """
    return pack_lengths(df, key, [length], batch_size=batch_size, seed=seed, digits=digits, fills=fills)[0]


def pack_lengths(
    df: DataFrame, key: str, lengths: list[int], *, batch_size: int = 1024, seed: int = 42, digits: int | None = None, fills: dict[str, int] = PACK_FILLS,
) -> list[DataFrame]:
    """``pack_shuffled`` for each of the lengths, from the same shuffle."""
    names = token_columns(df, fills)
    rows = df.select(key).count()
    slab_rows = slab_rows_for(rows, batch_size, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    slim = slim_rows(df.select(key, *names), names)
    placed = with_slab(slim, key, slab_rows, seed=seed, digits=digits_for(rows) if digits is None else digits)
    ordered = placed.repartition("slab").sortWithinPartitions("slab", "_key", key)
    kinds = {n: df.schema[n].dataType for n in names}
    return [pack_sorted(ordered, names, n, batch_size=batch_size, slab_rows=slab_rows, fills=fills, kinds=kinds) for n in lengths]


def pack_bands(
    df: DataFrame,
    key: str,
    bands: list[Band],
    length: int,
    *,
    batch_size: int = 1024,
    seed: int = 42,
    digits: int | None = None,
    fills: dict[str, int] = PACK_FILLS,
) -> DataFrame:
    """``band, batch, chunk`` and token arrays: the packed rows of every band, as if each had been selected,
    shuffled and packed alone, with one shuffle of the token arrays for all of them.

    A matrix of counts, buckets of the order by bands, gives the position at which each band goes on in a bucket, and
    running counts inside the bucket give each row its position in every band that holds it.
    Only batches that straddle two buckets move again. A few dozen bands at most: each is
    a running count of the window. ``df`` has the metric columns of the bands and is read twice.
    """
    names = token_columns(df, fills)
    digits = digits_for(df.select(key).count()) if digits is None else digits
    keyed = with_order_key(slim_rows(df, names), key, seed).withColumn("_bucket", bucket_of(F.col("_key"), digits))
    held = {f"_b{i}": band.contains() for i, band in enumerate(bands)}
    counts = keyed.groupBy("_bucket").agg(*[F.count_if(c).alias(n) for n, c in held.items()])
    starts = running_starts(counts, list(held), digits)
    if 16**digits * len(bands) <= BROADCAST_CELLS:  # the matrix is known to be small; so the rows stay in their buckets
        starts = F.broadcast(starts)
    before = Window.partitionBy("_bucket").orderBy("_key", key).rowsBetween(Window.unboundedPreceding, -1)
    # Conditions are columns before the window, so that they are evaluated once a row.
    placed = keyed.select("_bucket", "_key", key, *names, *[c.alias(n) for n, c in held.items()])
    placed = placed.withColumns({f"_n{i}": F.coalesce(F.count_if(n).over(before), F.lit(0)) for i, n in enumerate(held)}).join(starts, "_bucket")
    spots = F.array(*[
        F.when(F.col(n), F.struct(F.lit(band.label).alias("band"), (F.col(f"{n}_start") + F.col(f"_n{i}")).alias("ordinal"),
                                  F.col(f"{n}_start").alias("_from_"), F.col(f"{n}_rows").alias("_count_")))
        for i, (n, band) in enumerate(zip(held, bands))
    ])
    each = placed.select("_bucket", *names, F.explode_outer(F.filter(spots, lambda s: s.isNotNull())).alias("_s")).where("_s is not null")
    each = each.select("_bucket", *names, "_s.*")
    first = F.expr(f"(ordinal div {batch_size}) * {batch_size}")
    whole = (first >= F.col("_from_")) & (first + batch_size <= F.col("_from_") + F.col("_count_"))
    options = {"batch_size": batch_size, "fills": fills, "keep": ("band",)}
    inside = _pack(each.where(whole), names, length, within=("_bucket", "band"), **options)
    across = _pack(each.where(~whole), names, length, within=("band",), **options)
    return inside.unionByName(across)


def first_packed(rows: DataFrame, n: int) -> DataFrame:
    """The first ``min(n, rows)`` packed rows, a cap for short runs."""
    return rows.orderBy("batch", "chunk").limit(n)


# --- masking ----------------------------------------------------------------


def mask_tokens(
    df: DataFrame,
    key: Column,
    *,
    mask_id: int,
    vocab_size: int,
    probability: float = 0.15,
    seed: int = 42,
) -> DataFrame:
    """Add ``labels`` and mask ``input_ids`` for masked-token training.

    Of the ordinary tokens a share of ``probability`` is picked; 80% of those
    become the mask token, 10% a random token, 10% stay. Labels are ignored
    everywhere else. The draw is a hash of row key, position and seed: one
    digest gives four 32-bit draws, compared as hex text.
    """

    def threshold(share: float) -> Column:
        return F.lit(format(int(round(share * 2**32)), "08x"))

    row = key.cast("string")
    digests = F.transform(
        F.sequence(F.lit(0), F.expr("greatest(size(input_ids) - 1, 0) div 4")),
        lambda b: hash_key(row, b, seed=seed),
    )
    # Four draws per digest, so at least as many draws as tokens.
    draws = F.flatten(
        F.transform(digests, lambda d: F.array(*[F.substring(d, at, 8) for at in (1, 9, 17, 25)]))
    )

    def replacement(i: Column) -> Column:
        digest = hash_key(row, i, F.lit("random"), seed=seed)
        return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % vocab_size).cast("int")

    ordinary = F.zip_with(
        F.slice(draws, F.lit(1), F.size("input_ids")),
        "special_tokens_mask",
        lambda u, special: F.when((special == 0) & (u < threshold(probability)), u),
    )
    drawn = df.withColumn("_picked", ordinary)
    pairs = F.arrays_zip(F.col("input_ids").alias("t"), F.col("_picked").alias("u"))
    masked = F.transform(
        pairs,
        lambda x, i: F.when(x["u"].isNull(), x["t"])
        .when(x["u"] < threshold(probability * 0.8), F.lit(mask_id))
        .when(x["u"] < threshold(probability * 0.9), replacement(i))
        .otherwise(x["t"]),
    )
    labels = F.transform(pairs, lambda x: F.when(x["u"].isNull(), F.lit(IGNORED)).otherwise(x["t"]))
    return (
        drawn.withColumn("labels", labels).withColumn("input_ids", masked)
        .drop("_picked")
    )
