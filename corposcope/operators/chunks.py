"""Entity chunks in tag sequences and their scores.

A sequence is one row with a tag array, so chunks are found with array
functions inside the row: no explode, no window, no shuffle of tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import durable

# Which transitions start, continue and end an entity in the
# strict schemes, as previous prefix, current prefix and relation of the types.
STRICT_SCHEMES = {
    "IOB1": {
        "start": [("O", "I", "any"), ("I", "I", "diff"), ("B", "I", "any"), ("I", "B", "same"), ("B", "B", "same")],
        "inside": [("B", "I", "same"), ("I", "I", "same")],
        "end": [("I", "I", "diff"), ("I", "O", "any"), ("I", "B", "any"), ("B", "O", "any"), ("B", "I", "diff"), ("B", "B", "same")],
    },
    "IOE1": {
        "start": [("O", "I", "any"), ("I", "I", "diff"), ("E", "I", "any"), ("E", "E", "same")],
        "inside": [("I", "I", "same"), ("I", "E", "same")],
        "end": [("I", "I", "diff"), ("I", "O", "any"), ("I", "E", "diff"), ("E", "I", "same"), ("E", "E", "same")],
    },
    "IOB2": {
        "start": [("*", "B", "any")],
        "inside": [("B", "I", "same"), ("I", "I", "same")],
        "end": [("I", "O", "any"), ("I", "I", "diff"), ("I", "B", "any"), ("B", "O", "any"), ("B", "I", "diff"), ("B", "B", "any")],
    },
    "IOE2": {
        "start": [("O", "I", "any"), ("O", "E", "any"), ("E", "I", "any"), ("E", "E", "any"), ("I", "I", "diff"), ("I", "E", "diff")],
        "inside": [("I", "E", "same"), ("I", "I", "same")],
        "end": [("E", "*", "any")],
    },
    "IOBES": {
        "start": [("*", "B", "any"), ("*", "S", "any")],
        "inside": [("B", "I", "same"), ("B", "E", "same"), ("I", "I", "same"), ("I", "E", "same")],
        "end": [("S", "*", "any"), ("E", "*", "any")],
    },
    "BILOU": {
        "start": [("*", "B", "any"), ("*", "U", "any")],
        "inside": [("B", "I", "same"), ("B", "L", "same"), ("I", "I", "same"), ("I", "L", "same")],
        "end": [("U", "*", "any"), ("L", "*", "any")],
    },
}


def _prefix(tag: Column, suffix: bool) -> Column:
    return F.right(tag, F.lit(1)) if suffix else F.left(tag, F.lit(1))


def _type(tag: Column, suffix: bool) -> Column:
    """The entity type of a tag, ``_`` when it has none."""
    if suffix:
        rest = F.substring(tag, F.lit(1), F.length(tag) - 1)
        last = F.substring_index(rest, "-", -1)
        kind = F.when(
            F.contains(rest, F.lit("-")), F.substring(rest, F.lit(1), F.length(rest) - F.length(last) - 1)
        ).otherwise(rest)
    else:
        rest = F.substring(tag, F.lit(2), F.length(tag))
        kind = F.substring(rest, F.locate("-", rest) + 1, F.length(rest))
    return F.when(kind == "", "_").otherwise(kind)


def _any_of(patterns: list[tuple[str, str, str]], before: Column, now: Column, suffix: bool) -> Column:
    condition = F.lit(False)
    for left, right, relation in patterns:
        match = F.lit(True)
        if left != "*":
            match = match & (_prefix(before, suffix) == left)
        if right != "*":
            match = match & (_prefix(now, suffix) == right)
        if relation == "same":
            match = match & (_type(before, suffix) == _type(now, suffix))
        elif relation == "diff":
            match = match & (_type(before, suffix) != _type(now, suffix))
        condition = condition | match
    return condition


def _continues(before: Column, now: Column, suffix: bool) -> Column:
    """Lenient rule: the tag goes on with the chunk of the tag before it."""
    return (
        ~_prefix(now, suffix).isin("O", "B", "S")
        & ~_prefix(before, suffix).isin("O", "E", "S")
        & (_type(before, suffix) == _type(now, suffix))
    )


def with_chunks(
    df: DataFrame, tags: str, out: str, *,
    suffix: bool = False, scheme: str | None = None, strict: bool = False,
) -> DataFrame:
    """Add ``out``: the chunks of a tag array as ``start|end|type`` strings, end inclusive.

    Lenient by default: a chunk opens at any tag other than ``O`` that does not
    go on with the chunk before it, so ``I-x`` may open one. ``strict`` takes
    only sequences that are well formed in ``scheme``.
    """
    if scheme is not None and scheme not in STRICT_SCHEMES:
        raise ValueError(f"scheme should be one of {sorted(STRICT_SCHEMES)}, got {scheme}")
    rules = STRICT_SCHEMES[scheme] if strict and scheme else None

    def inside(before: Column, now: Column) -> Column:
        if rules is None:
            return _continues(before, now, suffix)
        return _any_of(rules["inside"], before, now, suffix)

    # Position i sees the tag before it; one outside tag closes the sequence.
    outside = F.array(F.lit("O"))
    pairs = F.arrays_zip(F.concat(outside, tags).alias("before"), F.concat(tags, outside).alias("now"))

    def mark(x: Column, i: Column) -> Column:
        """The position if a run starts there; of outside tags only the first matters."""
        before, now = x["before"], x["now"]
        idle = (before == "O") & (now == "O")
        fields = [i.alias("i"), now.alias("now")] + ([] if rules is None else [before.alias("before")])
        return F.when(~idle & ~inside(before, now), F.struct(*fields))

    breaks = F.filter(F.transform(pairs, mark), lambda x: x.isNotNull())

    def is_chunk(a: Column, b: Column) -> Column:
        if rules is None:
            return _prefix(a["now"], suffix) != "O"
        return _any_of(rules["start"], a["before"], a["now"], suffix) & _any_of(
            rules["end"], b["before"], b["now"], suffix
        )

    def chunk(a: Column, b: Column) -> Column:
        """A run lies between neighbouring breaks; null if it is no chunk."""
        bar = F.lit("|")
        text = F.concat(
            a["i"].cast("string"), bar, (b["i"] - 1).cast("string"), bar, _type(a["now"], suffix)
        )
        return F.when(is_chunk(a, b), text)

    count = F.greatest(F.size("_breaks") - 1, F.lit(0))
    text = F.filter(
        F.zip_with(F.slice("_breaks", F.lit(1), count), F.slice("_breaks", F.lit(2), count), chunk),
        lambda c: c.isNotNull(),
    )
    return df.withColumn("_breaks", breaks).withColumn(out, text).drop("_breaks")


def chunk_type(chunk: Column) -> Column:
    return F.substring(chunk, F.length(F.substring_index(chunk, "|", 2)) + 2, F.length(chunk))


def chunk_matches(df: DataFrame, key: str, predicted: str, reference: str, **scheme) -> DataFrame:
    """``(key, chunk, in_pred, in_ref)``: every chunk of either side once."""
    both = with_chunks(with_chunks(df, predicted, "_p", **scheme), reference, "_r", **scheme)
    return _sides(both, key).groupBy(key, "chunk").agg(
        F.max("p").alias("in_pred"), F.max("r").alias("in_ref")
    )


def _sides(both: DataFrame, *keep: str) -> DataFrame:
    def mark(chunks: Column, p: int, r: int, tp: int) -> Column:
        return F.transform(
            chunks,
            lambda c: F.struct(
                c.alias("chunk"), F.lit(p).alias("p"), F.lit(r).alias("r"), F.lit(tp).alias("tp")
            ),
        )

    marked = F.concat(
        mark(F.col("_p"), 1, 0, 0),
        mark(F.col("_r"), 0, 1, 0),
        mark(F.array_intersect("_p", "_r"), 0, 0, 1),
    )
    # The outer form keeps Spark from deriving a filter that finds the chunks again.
    return both.select(*keep, F.inline_outer(marked)).where("chunk is not null")


def chunk_counts(df: DataFrame, predicted: str, reference: str, **scheme) -> DataFrame:
    """``(type, tp, n_pred, n_ref)``: sides are matched inside the row, so only
    per-type counts are shuffled."""
    both = with_chunks(with_chunks(df, predicted, "_p", **scheme), reference, "_r", **scheme)
    return _sides(both).groupBy(chunk_type(F.col("chunk")).alias("type")).agg(
        F.sum("tp").alias("tp"), F.sum("p").alias("n_pred"), F.sum("r").alias("n_ref")
    )


def _scores(zero_division: float) -> dict[str, Column]:
    def share(bottom: str) -> Column:
        return F.when(F.col(bottom) == 0, F.lit(float(zero_division))).otherwise(F.col("tp") / F.col(bottom))

    precision, recall = share("n_pred"), share("n_ref")
    total = precision + recall
    harmonic = F.when(total == 0, F.lit(0.0)).otherwise(2 * precision * recall / total)
    return {"precision": precision, "recall": recall, "f1": harmonic}


def entity_scores(
    df: DataFrame, predicted: str, reference: str, *,
    suffix: bool = False, scheme: str | None = None, mode: str | None = None,
    weight: str | None = None, zero_division: int | str = "warn",
) -> DataFrame:
    """``type, precision, recall, f1, number`` per entity type and, as ``overall``,
    over all chunks.

    Strict matching needs ``mode="strict"`` and a scheme. ``zero_division``
    (0, 1 or "warn", which counts as 0) fills scores with an empty denominator.
    ``weight`` names a column of row weights; chunks are counted whole in these
    scores, so it is accepted but changes none of them.
    """
    if weight is not None and weight not in df.columns:
        raise ValueError(f"no column {weight}")
    if mode not in (None, "strict"):
        raise ValueError("mode must be None or 'strict'")
    fill = 0 if zero_division == "warn" else zero_division
    if fill not in (0, 1):
        raise ValueError("zero_division must be 0, 1 or 'warn'")
    # A row per type: written, as a filter on the scores would else find all chunks again below the aggregate.
    counts = durable(chunk_counts(df, predicted, reference, suffix=suffix, scheme=scheme, strict=mode == "strict"))
    # Aggregated without grouping, the overall row is there even if no side has a chunk.
    none = F.lit(0).cast("long")
    overall = counts.agg(*[F.coalesce(F.sum(c), none).alias(c) for c in ("tp", "n_pred", "n_ref")])
    both = counts.unionByName(overall.withColumn("type", F.lit("overall")))
    scores = _scores(fill)
    return both.select("type", *[c.alias(n) for n, c in scores.items()], F.col("n_ref").alias("number"))


def tag_accuracy(df: DataFrame, predicted: str, reference: str) -> DataFrame:
    """Share of equal tags over all positions."""
    equal = F.size(F.filter(F.zip_with(predicted, reference, lambda p, r: p == r), lambda x: x))
    counts = df.agg(F.sum(equal).alias("hits"), F.sum(F.size(reference)).alias("tags"))
    return counts.select(F.try_divide("hits", "tags").alias("accuracy"))


def flat_scores(scores: DataFrame, accuracy: DataFrame | None = None) -> DataFrame:
    """``(metric, value)`` with one ``type_metric`` row per score, and ``overall_accuracy``
    where the table of ``tag_accuracy`` is given. The overall row has no number."""
    names = ["precision", "recall", "f1", "number"]
    cells = F.array(
        *[F.struct(F.lit(n).alias("m"), F.col(n).cast("double").alias("value")) for n in names]
    )
    rows = scores.select("type", F.inline(cells)).where("type <> 'overall' or m <> 'number'")
    flat = rows.select(F.concat_ws("_", "type", "m").alias("metric"), "value")
    if accuracy is None:
        return flat
    return flat.unionByName(accuracy.select(F.lit("overall_accuracy").alias("metric"), F.col("accuracy").alias("value")))


def overall_scores(scores: DataFrame, accuracy: DataFrame) -> DataFrame:
    """The four-value form ``(metric, value)``: precision, recall and f1 over all chunks, and tag accuracy."""
    cells = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in ("precision", "recall", "f1")])
    rows = scores.where("type = 'overall'").select(F.inline(cells))
    return rows.unionByName(accuracy.select(F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value")))
