"""Array columns: lengths, labels, logits. All higher-order functions, no explode."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the label of positions that no metric or loss looks at.
IGNORED = -100


def truncated(values: Column, length: int) -> Column:
    return F.slice(values, 1, length)


def fixed_length(values: Column, length: int, pad) -> Column:
    """Cut or right-pad an array to exactly ``length`` elements."""
    missing = F.greatest(F.lit(length) - F.size(values), F.lit(0))
    return F.concat(truncated(values, length), F.array_repeat(F.lit(pad), missing))


def slimmed(values: Column, size: Column) -> Column:
    """An array of ``size`` elements as ``first, mid, last``, and ``full`` where those between the ends differ or are null.

    Masks of a sequence are of that form, so that they need not be moved or sorted element by element.
    """
    inner = F.slice(values, 2, F.greatest(size - 2, F.lit(0)))
    mid, first, last = F.get(values, F.lit(1)), F.get(values, F.lit(0)), F.get(values, size - 1)
    even = (F.size(values) == size) & ((size <= 2) | (mid.isNotNull() & (inner == F.array_repeat(mid, size - 2))))
    even = even & ((size < 1) | (first.isNotNull() & last.isNotNull()))
    return F.struct(first.alias("first"), mid.alias("mid"), last.alias("last"), F.when(~F.coalesce(even, F.lit(False)) & (size > 0), values).alias("full"))


def part_of_slimmed(slim: Column, size: Column, begin: Column, take: Column) -> Column:
    """``take`` elements of a slimmed array from the 0-based ``begin``."""
    head = ((begin == 0) & (take > 0)).cast("int")
    tail = ((begin + take == size) & (take > 0) & (size > 1)).cast("int")
    even = F.concat(
        F.array_repeat(slim["first"], head), F.array_repeat(slim["mid"], take - head - tail), F.array_repeat(slim["last"], tail)
    )
    return F.when(slim["full"].isNull(), even).otherwise(F.slice(slim["full"], begin + 1, take))


def whole_of_slimmed(slim: Column, size: Column) -> Column:
    """The array again; null where it was null."""
    return F.when(size >= 0, part_of_slimmed(slim, size, F.lit(0), size))


def multi_hot(ids: Column, n: int) -> Column:
    """Label ids as a 0/1 vector of ``n`` doubles."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.array_contains(ids, i).cast("double")
    )


def argmax(logits: Column) -> Column:
    """0-based index of the largest value; the first one wins a tie."""
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")


def positive_flags(logits: Column) -> Column:
    """1 where a logit is above zero, else 0."""
    return F.transform(logits, lambda v: (v > 0).cast("int"))


def active_labels(flags: Column, names: list[str]) -> Column:
    """Names of the labels whose flag is 1."""
    table = F.array(*[F.lit(n) for n in names])
    return F.filter(
        F.zip_with(flags, table, lambda flag, name: F.when(flag == 1, name)),
        lambda name: name.isNotNull(),
    )


def visible_pairs(predicted: Column, labels: Column) -> Column:
    """``(p, l)`` pairs at the positions whose label is not ignored, in order."""
    pairs = F.zip_with(predicted, labels, lambda p, l: F.struct(p.alias("p"), l.alias("l")))
    return F.filter(pairs, lambda x: x["l"] != IGNORED)


def first_as_int(values: Column) -> Column:
    """First element of a list column as an int; null when the list is empty."""
    return F.get(values, F.lit(0)).try_cast("int")


def bound(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` computed once per row.

    Inside the lambda of a higher-order function a column expression would be
    computed again for every element; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def aligned_labels(
    word_ids: Column, word_labels: Column, inside: Column | None = None
) -> Column:
    """Word labels spread over word pieces.

    ``word_ids`` gives the word of each piece, null for special tokens.
    The first piece of a word takes its label; special tokens are ignored.
    Later pieces are ignored too, or take ``inside[label]`` when that array
    (label id to inside-label id) is given.
    """
    none = F.array(F.lit(None).cast("int"))

    def spread(row: Column) -> Column:
        ids = row["ids"]
        # One longer than the ids: the word before each piece, none at the start.
        before = F.concat(none, ids)

        def label(word: Column, previous: Column) -> Column:
            own = F.get(row["labels"], word)
            later = F.lit(IGNORED) if inside is None else F.get(row["inside"], own)
            return F.when(word == previous, later).otherwise(own)

        return F.zip_with(
            F.concat(ids, none),
            before,
            lambda word, previous: F.coalesce(label(word, previous), F.lit(IGNORED)),
        )

    parts = [word_ids.cast("array<int>").alias("ids"), word_labels.alias("labels")]
    if inside is not None:
        parts.append(inside.alias("inside"))
    spread_labels = bound(F.struct(*parts), spread)
    return F.slice(spread_labels, F.lit(1), F.size(word_ids))
