"""Near-duplicates by SimHash, found with the generalised pigeonhole principle.

The 64 bits of a fingerprint are grouped into partitions of correlated bits. Each partition gets
its own threshold, and the thresholds add up so that two fingerprints at most ``DISTANCE`` bits apart agree
within the threshold of some partition at least. Dynamic programming picks the thresholds with the
fewest rows and candidates, estimated from counts over all fingerprints. Fingerprints that meet under a
partition's value are verified in their bucket, which passes on links that span it, not its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import runs_of, slices, stored
from .components import components

SHINGLE = 3
SEED = 42
DISTANCE = 3
BITS = 64
# Numbers of partitions that are compared, and the cost of a row dealt out against a pair compared.
PARTITIONS = (2, 3, 4)
ROW_COST = 400.0
# A bucket with more members is cut into blocks that are compared two by two.
BUCKET_ROWS = 4096
# Text that is shingled at a time; more of it would not go faster.
SHINGLED_BYTES = 1 << 20
# Up to this many members all pairs of a bucket are compared at once with those of other buckets.
SMALL = 8


def text_fingerprints(texts: pa.Array, *, words: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The fingerprint of each text, a bit being set if it is in over half of the hashes of
    the shingles, repeats included. Fewer words are one shingle; none give 0."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, ends = parts.flatten(), parts.offsets.to_numpy()
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(real)])[ends - ends[0]]
    flat = flat.filter(pa.array(real))
    out = np.zeros(len(texts), np.uint64)
    if not len(flat):
        return out
    sizes = pc.binary_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    stops = starts + sizes
    first, counts = runs_of(ends, words)
    short = np.flatnonzero((counts == 0) & (np.diff(ends) > 0))
    begin = np.concatenate([starts[first], starts[ends[short]]])
    end = np.concatenate([stops[first + words - 1], stops[ends[short + 1] - 1]])
    joined = " ".join(flat.to_pylist()).encode()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(begin.tolist(), end.tolist())), np.uint64, len(begin))
    row = np.concatenate([np.repeat(np.arange(len(counts)), counts), short])
    order = np.argsort(row, kind="stable") if len(short) else slice(None)
    hashes, row = hashes[order], row[order]
    have, at, n = np.unique(row, return_index=True, return_counts=True)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, at, axis=0, dtype=np.int32)
    out[have] = np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprint(text: str = "text", *, words: int = SHINGLE, seed: int = SEED) -> Column:
    """The fingerprint of a text column as a signed long."""

    @F.arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [text_fingerprints(p.column(0), words=words, seed=seed) for p in slices(pa.record_batch([texts], ["t"]), "t", SHINGLED_BYTES)]
            yield pa.array(np.concatenate(parts).view(np.int64) if parts else [], pa.int64())

    return of(F.col(text).cast("string"))


# --- planning ----------------------------------------------------------------


def bit_counts(fingerprints: DataFrame) -> tuple[np.ndarray, int]:
    """How often bits are set together, over all fingerprints, and their number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for part in np.array_split(values, len(values) // 50_000 + 1):
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total += bits.T @ bits
        yield pa.record_batch([pa.array(range(BITS * BITS), pa.int32()), pa.array(total.ravel())], ["at", "n"])

    rows = fingerprints.select("fp").mapInArrow(count, "at int, n double").groupBy("at").agg(F.sum("n").alias("n")).collect()
    together = np.zeros(BITS * BITS)
    for r in rows:
        together[r["at"]] = r["n"]
    return together.reshape(BITS, BITS), fingerprints.count()


def correlated_groups(together: np.ndarray, n: int, groups: int) -> list[list[int]]:
    """The bits in ``groups`` groups of about equal size; a group grows by the bit that is most
    correlated with its bits so far, from the most correlated pair that is left."""
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    related = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(related, 0)
    left, out = list(range(BITS)), []
    for g in range(groups):
        size = len(left) // (groups - g)
        inner = related[np.ix_(left, left)]
        group = [left[int(inner.sum(axis=1).argmax())]]
        while len(group) < size:
            rest = [b for b in left if b not in group]
            group.append(rest[int(related[np.ix_(rest, group)].sum(axis=1).argmax())])
        left = [b for b in left if b not in group]
        out.append(sorted(group))
    return out


def _mask(bits) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def _collisions(fingerprints: DataFrame, masks: list[int]) -> list[float]:
    """For each mask: ordered pairs of fingerprints that agree under it, the same one included."""
    keys = F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)])
    counts = fingerprints.select(F.inline(keys)).groupBy("part", "key").agg(F.count("*").cast("double").alias("n"))
    found = {r["part"]: r["pairs"] for r in counts.groupBy("part").agg(F.sum(F.col("n") * F.col("n")).alias("pairs")).collect()}
    return [found.get(i, 0.0) for i in range(len(masks))]


def thresholds(costs: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """The cheapest threshold of each partition, -1 (not probed) or more, adding up to ``budget``:
    ``costs[i][t + 1]`` is the cost of threshold t in partition i."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for used, (total, chosen) in best.items():
            for t, more in enumerate(cost, start=-1):
                now = (total + more, [*chosen, t])
                if used + t not in after or now[0] < after[used + t][0]:
                    after[used + t] = now
        best = after
    return best[budget]


def probe_plan(fingerprints: DataFrame, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """The partitions, as lists of bits, and their thresholds; those not probed are left out."""
    together, n = bit_counts(fingerprints)
    p = np.diag(together) / max(n, 1)
    differ = np.clip(2 * p * (1 - p), 1e-6, 0.5)
    odds = differ / (1 - differ)
    layouts = [correlated_groups(together, n, m) for m in PARTITIONS if m <= distance + 1]
    same = iter(_collisions(fingerprints, [_mask(g) for layout in layouts for g in layout]))
    plans = []
    for layout in layouts:
        costs = []
        for bits in layout:
            agree = max(next(same) - n, 0.0)  # pairs that agree in all bits
            ways = np.array([1.0])  # generating function: which bits differ, given all others agree
            for b in bits:
                ways = np.convolve(ways, [1.0, odds[b]])[: distance + 1]
            row = [0.0]
            for t in range(distance + 1):
                probes = sum(math.comb(len(bits), k) for k in range(t + 1))
                row.append(max(n, 1) * probes * ROW_COST + agree * float(ways[: t + 1].sum()))
            costs.append(row)
        total, chosen = thresholds(costs, distance - len(layout) + 1)
        plans.append((total, [(bits, t) for bits, t in zip(layout, chosen) if t >= 0]))
    return min(plans, key=lambda x: x[0])[1]


# --- probing and verifying -----------------------------------------------------


def _members(fingerprints: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """``(part, key, fp, probe)``: each fingerprint under its own value in every partition, and as a
    probe under the values that differ in up to the threshold of bits."""
    parts = []
    for part, (bits, threshold) in enumerate(plan):
        flips = [_mask(c) for k in range(threshold + 1) for c in combinations(bits, k)]
        spelled = F.from_json(F.lit(str(flips)), "array<long>")
        struct = F.struct(F.lit(part).alias("part"), F.lit(_mask(bits)).alias("mask"), spelled.alias("flips"))
        parts.append(struct)
    dealt = fingerprints.select("fp", F.inline(F.array(*parts))).select("fp", "part", "mask", F.explode("flips").alias("flip"))
    key = F.col("fp").bitwiseAND(F.col("mask")).bitwiseXOR(F.col("flip"))
    return dealt.select("fp", "part", key.alias("key"), (F.col("flip") != 0).alias("probe"))


def _spanning(fps: np.ndarray, probe: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Links that connect what the verified pairs of one bucket connect; two probes don't pair."""
    left = np.arange(len(fps))
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            x = frontier.pop()
            near = np.bitwise_count(fps[left] ^ fps[x]) <= distance
            if probe[x]:
                near &= ~probe[left]
            for y in left[near]:
                frontier.append(y)
                yield x, y
            left = left[~near]


def _verifier(distance: int):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def links(table: pa.Table) -> pa.RecordBatch:
        columns = [table.column(c).to_numpy() for c in ("part", "key", "cell")]
        fps = table.column("fp").to_numpy().view(np.uint64)
        probe = table.column("probe").to_numpy()
        new = np.ones(len(fps), bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        starts = np.flatnonzero(new)
        sizes = np.diff([*starts, len(fps)])
        us, vs = [], []
        bucket = np.repeat(np.arange(len(starts)), sizes)
        small = sizes <= SMALL
        for gap in range(1, min(SMALL, len(fps))):
            a, b = fps[:-gap], fps[gap:]
            hit = (bucket[:-gap] == bucket[gap:]) & small[bucket[gap:]] & ~(probe[:-gap] & probe[gap:])
            hit &= np.bitwise_count(a ^ b) <= distance
            us.append(a[hit])
            vs.append(b[hit])
        for s, n in zip(starts[~small], sizes[~small]):
            pairs = np.array(list(_spanning(fps[s : s + n], probe[s : s + n], distance)), np.int64).reshape(-1, 2)
            us.append(fps[s + pairs[:, 0]])
            vs.append(fps[s + pairs[:, 1]])
        u, v = (np.concatenate(x or [fps[:0]]).view(np.int64) for x in (us, vs))
        return pa.record_batch([pa.array(u), pa.array(v)], schema=schema)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if not held.num_rows:
                continue
            # The last bucket may go on in the next batch.
            last = np.ones(held.num_rows, bool)
            for c in ("part", "key", "cell"):
                values = held.column(c).to_numpy()
                last &= values == values[-1]
            cut = held.num_rows - int(last.sum())
            if cut:
                yield links(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield links(held)

    return verify


def hamming_links(fingerprints: DataFrame, *, distance: int = DISTANCE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(u, v)``: links between distinct fingerprints (``fp``) at most ``distance`` bits apart, as many
    as connect what all such links connect.

    Values that one fingerprint alone has are dropped after a counted aggregate. A bucket above
    ``bucket_rows`` members is cut into blocks by a hash, and every two blocks are compared in a
    task of their own, so no bucket is a single task and none is capped.
    """
    members = stored(_members(fingerprints, probe_plan(fingerprints, distance)), "members")
    counts = members.groupBy("part", "key").agg(F.count("*").alias("n"), F.count_if(~F.col("probe")).alias("own"))
    counts = counts.where("n > 1 and own > 0").drop("own")
    blocks = F.ceil(F.col("n") / bucket_rows).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (
        members.join(counts, ["part", "key"]).withColumn("blocks", blocks).withColumn("own", own).withColumn("other", other)
        .withColumn("cell", F.least("own", "other") * F.col("blocks").cast("long") + F.greatest("own", "other"))
        .select("part", "key", "cell", "fp", "probe")
    )
    sorted_ = dealt.repartition("part", "key", "cell").sortWithinPartitions("part", "key", "cell", "fp", "probe")
    return sorted_.mapInArrow(_verifier(distance), "u long, v long")


def near_duplicates(docs: DataFrame, *, distance: int = DISTANCE, words: int = SHINGLE) -> DataFrame:
    """``(doc_id, text_key, fp, component_id, links, root)``, one per row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` that a chain of links between fingerprints reaches,
    the row itself included; ``links`` counts the other rows with the same fingerprint and the
    fingerprints of the spanning links. ``text_key`` is a hash of the text that tells rows of one ``doc_id``
    apart, ``root`` the smallest fingerprint of the component, which identifies it. Null and empty texts have fingerprint 0 and link like any other; a null id is no
    smallest one unless all are; an empty table gives no rows.
    """
    light = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_key"), fingerprint(words=words).alias("fp"))
    light = stored(light, "fingerprints")
    distinct = stored(light.groupBy("fp").agg(F.min("doc_id").alias("id"), F.count("*").alias("n")), "distinct")
    links = stored(hamming_links(distinct.select("fp"), distance=distance).distinct(), "fp_links")
    ends = links.select(F.col("u").alias("fp")).unionByName(links.select(F.col("v").alias("fp")))
    degree = ends.groupBy("fp").agg(F.count("*").alias("degree"))
    roots = components(links)
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fp")).drop("node")
    smallest = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    classes = rooted.join(smallest, "root").join(degree, "fp", "left").select(
        "fp", "root", "component_id", (F.col("n") - 1 + F.coalesce("degree", F.lit(0))).alias("links")
    )
    return light.join(stored(classes, "classes"), "fp").select("doc_id", "text_key", "fp", "component_id", "links", "root")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each group, with all its columns, whatever their names: the smallest ``doc_id``, null ids last, then
    the smallest text hash; of rows that repeat both any one.

    Null and empty texts are a group like any other. An empty table stays empty.
    """
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    chosen = near_duplicates(docs).groupBy("root").agg(F.min(first).alias("c"))
    chosen = chosen.select(F.col("c.doc_id").alias("_id"), F.col("c.text_key").alias("_key"))
    rows = docs.select(F.col("doc_id").cast("long").alias("_own"), F.xxhash64(F.col("text").cast("string")).alias("_text"), F.struct("*").alias("_row"))
    kept = rows.join(chosen, F.col("_id").eqNullSafe(F.col("_own")) & (F.col("_key") == F.col("_text")), "left_semi")
    return kept.dropDuplicates(["_own", "_text"]).select("_row.*")
