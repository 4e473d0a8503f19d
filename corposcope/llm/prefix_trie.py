"""The prefix trie of conversations, from padded matrices of turn ids.

Conversations that share their first turns share nodes. The sequences of turn ids are sorted by ranges over
the cluster. A slice of the sorted rows is a padded matrix: a lexsort, the columns in which a row
differs from the one before, or-accumulated from the left, mark where nodes start, and reduceat sums up
every depth at once. Nodes on the paths of a slice's first and last rows may go on in neighbouring slices;
they are passed on as parts under a digest of their path, and summed up after a shuffle of their own.

A matrix has at most ``COLUMNS`` turns. Longer conversations go on in further matrices, grouped by the node
that the first one ended in; a conversation that is alone in that node is a chain, one row for each turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import partitions, stored
from .mixing import word_count

SHARED_WITH = 20  # conversations whose ids start from the same multiple of this take its first turns
MOST_SHARED = 4
COLUMNS = 256
SLICE_ROWS = 8192
NO_ENDS = hashlib.sha256(b"").hexdigest()

RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_PART = pa.schema(
    [("kind", pa.string()), ("grp", pa.int64()), ("depth", pa.int64()), ("key", pa.binary()), ("parent_key", pa.binary()),
     ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
     ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string()), ("part", pa.int64()), ("at", pa.int64()),
     ("ids", pa.list_(pa.binary())), ("words", pa.list_(pa.int64())), ("longer", pa.bool_())]
)
_DDL = (
    "kind string, grp long, depth long, key binary, parent_key binary, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends string, part long, at long, ids array<binary>, words array<long>, longer boolean"
)


def shared_turns(conv_id: Column) -> Column:
    """How many first turns a conversation takes from the one that its ids start from."""
    return (F.crc32(conv_id.cast("string")) % MOST_SHARED).cast("int")


def _turn_id(role: str, text: str) -> Column:
    """A 128-bit digest that stands for one turn: the length of the role keeps the two apart."""
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, F.lit("\n"), text)))


# --- the turns of the conversations ------------------------------------------------


def placed_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, id, words)``: the turns of each conversation by turn (null first), then role and text.

    One range-partitioned sort, so that a conversation of any length is spread over tasks; a position is the
    one inside the task and the rows that earlier tasks hold of the conversation.
    """
    spark = conversations.sparkSession
    clean = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    )
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    sorted_ = clean.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    turns = stored(
        sorted_.select("conv_id", _turn_id("role", "text").alias("id"), word_count().alias("words"), F.monotonically_increasing_id().alias("at"))
        .withColumn("part", F.shiftright("at", 33)),
        "turns",
    )
    pieces = turns.groupBy("conv_id", "part").agg(F.min("at").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("conv_id", "part", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    return turns.join(pieces, ["conv_id", "part"]).select("conv_id", (F.col("at") + F.col("_shift")).alias("pos"), "id", "words")


def with_shared_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation with its first turns replaced by those of the one its ids start from: the turns, and
    ``(conv_id, n)`` of all conversations, those that have no turn left included."""
    turns = stored(turns, "placed")
    own = stored(turns.groupBy("conv_id").agg(F.count("*").alias("n_own")), "own_turns")
    base = F.col("conv_id") - F.col("conv_id") % SHARED_WITH
    plan = own.select("conv_id", "n_own", base.alias("base"), F.when(base == F.col("conv_id"), 0).otherwise(shared_turns(F.col("conv_id"))).alias("h"))
    sizes = own.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    plan = plan.join(sizes, "base", "left").withColumn("taken", F.least(F.col("h").cast("long"), F.coalesce("n_base", F.lit(0).cast("long"))))
    plan = stored(plan, "shared")
    kept = turns.join(plan.select("conv_id", "h", "taken"), "conv_id").where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "id", "words")
    first = turns.where((F.col("conv_id") % SHARED_WITH == 0) & (F.col("pos") < MOST_SHARED - 1)).withColumnRenamed("conv_id", "base")
    given = plan.where("taken > 0").select("base", "conv_id", "taken").join(first, "base").where("pos < taken").select("conv_id", "pos", "id", "words")
    lengths = plan.select("conv_id", (F.col("taken") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("n"))
    return kept.unionByName(given), lengths


# --- one slice as a matrix ----------------------------------------------------------


def _path_keys(grp: int, ids: list[bytes]) -> list[bytes]:
    """A digest for the node at each depth of a path, the empty path first."""
    state = hashlib.blake2b(grp.to_bytes(8, "little", signed=True), digest_size=16)
    keys = [state.digest()]
    for x in ids:
        state.update(x)
        keys.append(state.digest())
    return keys


def _common(a: tuple, b: tuple) -> int:
    """Turns that two paths ``(grp, ids, ...)`` share from the start; -1 for paths of two groups."""
    if a[0] != b[0]:
        return -1
    n = 0
    for x, y in zip(a[1], b[1]):
        if x != y:
            break
        n += 1
    return n


def _rejoined(before: tuple, first: tuple) -> list[dict]:
    """What was counted twice because the slice that begins with ``first`` took its nodes as new ones: texts and
    children that the path ``before`` has too, and the leaf that ``first`` continues or repeats."""
    shared = _common(before, first)
    keys = _path_keys(first[0], first[1][: max(shared, 0)])
    repeated = sum(first[2][:shared]) if shared > 0 else 0
    leaf = shared == len(before[1]) and not before[3]
    out = []
    for d in range(shared + 1):
        # The words of the last text of this node and of the shared ones below it count once less.
        words = repeated - sum(first[2][: d - 1]) if d else repeated
        out.append({"kind": "open", "grp": first[0], "depth": d, "key": keys[d], "parent_key": keys[d - 1] if d else None,
                    "n_convs": 0, "n_children": -int(d < shared), "n_leaves": -int(leaf), "saved_tokens": words})
    return out


class _Slice:
    """The nodes of consecutive sorted rows."""

    def __init__(self, batch: pa.RecordBatch):
        lists = batch.column("ids")
        n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        rows, width = len(n), int(n.max()) + 1
        coded = lists.flatten().dictionary_encode()
        column = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("grp", "conv_id", "longer", "saved", "leaves", "children")}
        row = np.repeat(np.arange(rows), n)
        place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        matrix = np.zeros((rows, width), np.int64)
        matrix[:, 0] = column["grp"]
        matrix[row, place + 1] = coded.indices.to_numpy(zero_copy_only=False) + 1  # 0 pads
        words = np.zeros((rows, width), np.int64)
        words[row, place + 1] = batch.column("words").flatten().to_numpy(zero_copy_only=False)
        # By columns from the left, then conversations that end here before those that go on, then by id.
        order = np.lexsort((column["conv_id"], column["longer"], *matrix.T[::-1]))
        matrix, words, n = matrix[order], words[order], n[order]
        column = {c: v[order] for c, v in column.items()}

        depth = np.arange(width)
        changed = np.ones((rows, width), bool)
        np.logical_or.accumulate(matrix[1:] != matrix[:-1], axis=1, out=changed[1:])
        exists = depth <= n[:, None]
        starts = changed & exists
        first_new = np.where(changed.any(axis=1), changed.argmax(axis=1), width)
        tail = np.cumsum(words[:, ::-1], axis=1)[:, ::-1]  # words of a row from a depth on
        tail = np.concatenate([tail, np.zeros((rows, 1), np.int64)], axis=1)
        leaf = ~column["longer"]
        leaf[:-1] &= first_new[1:] <= n[:-1]

        # Cells by depth, then by row: those of one node are neighbours.
        d, i = np.nonzero(exists.T)
        head = np.flatnonzero(starts[i, d])
        node = np.cumsum(starts[i, d]) - 1
        node_of = np.full((width, rows), -1, np.int64)
        node_of[d, i] = node
        texts_once = np.where(first_new[i] <= n[i], tail[i, np.maximum(d, first_new[i])], 0)
        add = lambda values: np.add.reduceat(values, head)
        self.grp, self.depth = column["grp"][i[head]], d[head]
        self.conv_id = np.minimum.reduceat(column["conv_id"][i], head)
        self.n_convs = add(np.ones(len(d), np.int64))
        self.n_children = add(((first_new[i] <= d + 1) & (d < n[i])).astype(np.int64) + np.where(d == n[i], column["children"][i], 0))
        self.n_leaves = add(leaf[i].astype(np.int64) + column["leaves"][i])
        self.saved = add(tail[i, d] - texts_once + column["saved"][i])
        self.parent = np.where(self.depth > 0, node_of[self.depth - 1, i[head]], -1)
        ends = np.flatnonzero((d == n[i]) & ~column["longer"][i])
        self.ends: dict[int, list[str]] = {}
        for k, c in zip(node[ends].tolist(), column["conv_id"][i[ends]].tolist()):
            self.ends.setdefault(k, []).append(str(c))
        # The paths of the first and the last row, which may go on outside the slice.
        self.keys: dict[int, bytes] = {}
        self.paths = []
        for r in (0, rows - 1):
            at = int(np.flatnonzero(order == r)[0])
            path = (int(column["grp"][at]), lists[r].as_py(), batch.column("words")[r].as_py(), bool(column["longer"][at]))
            self.paths.append(path)
            self.keys.update(zip(node_of[: n[at] + 1, at].tolist(), _path_keys(path[0], path[1])))

    def rows(self) -> pa.RecordBatch:
        keys, n = self.keys, len(self.depth)
        is_open = np.zeros(n, bool)
        is_open[list(keys)] = True
        key = [keys.get(k) if o else None for k, o in enumerate(is_open)] if is_open.any() else [None] * n
        parents = self.parent.tolist()
        parent_key = [keys.get(p) if p >= 0 else None for p in parents]
        parent_conv = self.conv_id[np.maximum(self.parent, 0)]
        no_parent = (self.parent < 0) | np.array([k is not None for k in parent_key])
        ends = [",".join(self.ends[k]) if k in self.ends else "" for k in range(n)]
        ends = [(e or None) if o else hashlib.sha256(e.encode()).hexdigest() if e else NO_ENDS for e, o in zip(ends, is_open)]
        given = {
            "kind": np.where(is_open, "open", "closed"), "grp": self.grp, "depth": self.depth, "key": key, "parent_key": parent_key,
            "conv_id": self.conv_id, "parent_conv_id": pa.array(parent_conv, pa.int64(), mask=no_parent), "n_convs": self.n_convs,
            "n_children": self.n_children, "n_leaves": self.n_leaves, "saved_tokens": self.saved, "ends": ends,
        }
        return _batch(given, n)


def _batch(given: dict, n: int) -> pa.RecordBatch:
    columns = [given.get(f.name) for f in _PART]
    return pa.record_batch([pa.nulls(n, f.type) if c is None else c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _PART)], schema=_PART)


def _batch_of(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_PART)


def _sharder(slice_rows: int):
    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, before = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            for start in range(0, batch.num_rows, slice_rows):
                found = _Slice(batch.slice(start, slice_rows))
                rows = found.rows()
                rows = rows.set_column(rows.schema.get_field_index("part"), _PART.field("part"), pa.array([part] * len(rows), pa.int64()))
                yield rows.set_column(rows.schema.get_field_index("at"), _PART.field("at"), pa.array([at] * len(rows), pa.int64()))
                first, last = found.paths
                if before is None:
                    yield _batch_of([{"kind": "first", "part": part, "grp": first[0], "ids": first[1], "words": first[2], "longer": first[3]}])
                else:
                    yield _batch_of(_rejoined(before, first))
                before, at = last, at + 1
        if before is not None:
            yield _batch_of([{"kind": "last", "part": part, "grp": before[0], "ids": before[1], "words": before[2], "longer": before[3]}])

    return shard


# --- slices together -----------------------------------------------------------------


def _edges(parts: DataFrame) -> DataFrame:
    """Corrections between the last row of a task and the first of the next one that has rows."""
    ends = parts.where("kind in ('first', 'last')").groupBy("part").agg(
        *[F.max(F.when(F.col("kind") == k, F.struct("grp", "ids", "words", "longer"))).alias(k) for k in ("first", "last")]
    )
    # A row for each task that sorted: bounded by the number of shuffle partitions.
    pairs = ends.select("first", F.lag("last").over(Window.orderBy("part")).alias("before")).where("before is not null")

    def rejoin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                first, before = (tuple(row[c][f] for f in ("grp", "ids", "words", "longer")) for c in ("first", "before"))
                rows = _rejoined(before, first)
                if rows:
                    yield _batch_of(rows)

    return pairs.mapInArrow(rejoin, _DDL)


def _digests(chunks: DataFrame) -> DataFrame:
    """``(key, ends_sha256)``: the hash of the joined ids of a node whose ids come in several slices.

    A slice sends its ids as one row; the rows of a node are hashed in order as they pass by, never held together.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for k, ends in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
                if k == key:
                    state.update(b"," + ends.encode())
                else:
                    if state is not None:
                        out.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(ends.encode())
            if out:
                yield pa.record_batch([pa.array([k for k, _ in out], pa.binary()), pa.array([s for _, s in out])], ["key", "ends_sha256"])
        if state is not None:
            yield pa.record_batch([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends_sha256"])

    ordered = chunks.select("key", "part", "at", "ends").repartition("key").sortWithinPartitions("key", "part", "at")
    return ordered.mapInArrow(digest, "key binary, ends_sha256 string")


def _matrix_nodes(heads: DataFrame, slice_rows: int) -> DataFrame:
    """``RESULT`` and ``grp`` for rows ``(grp, conv_id, ids, words, longer, saved, leaves, children)``."""
    order = ["grp", "ids", "longer", "conv_id"]
    sorted_ = heads.repartitionByRange(partitions(heads.sparkSession), *order).sortWithinPartitions(*order)
    parts = stored(sorted_.mapInArrow(_sharder(slice_rows), _DDL), "trie_parts")
    counted = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    open_ = parts.where("kind = 'open'").unionByName(_edges(parts))
    whole = open_.groupBy("grp", "depth", "key").agg(F.min("conv_id").alias("conv_id"), F.max("parent_key").alias("parent_key"), *[F.sum(c).alias(c) for c in counted])
    whole = stored(whole.join(_digests(parts.where("kind = 'open' and ends is not null")), "key", "left"), "open_nodes")
    nodes = parts.where("kind = 'closed'").select("grp", "depth", "conv_id", "parent_conv_id", "parent_key", *counted, F.col("ends").alias("ends_sha256"))
    nodes = nodes.unionByName(
        whole.select("grp", "depth", "conv_id", F.lit(None).cast("long").alias("parent_conv_id"), "parent_key", *counted, F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
    )
    names = whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    under_open = nodes.where("parent_key is not null").join(names, "parent_key").withColumn("parent_conv_id", F.col("_parent"))
    return nodes.where("parent_key is null").select("grp", *RESULT).unionByName(under_open.select("grp", *RESULT))


def _heads(turns: DataFrame, members: DataFrame, offset: int, columns: int) -> DataFrame:
    """Rows of a matrix: the turns ``offset`` to ``offset + columns`` of each of ``members`` (``grp``, ``conv_id``, ``n``)."""
    turn = F.struct("pos", "id", "words")
    found = turns.where((F.col("pos") >= offset) & (F.col("pos") < offset + columns)).groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    empty = F.array().cast("array<struct<pos: bigint, id: binary, words: bigint>>")
    got = F.coalesce("_turns", empty)
    return members.join(found, "conv_id", "left").select(
        "grp", "conv_id", got.getField("id").alias("ids"), got.getField("words").alias("words"), (F.col("n") > offset + columns).alias("longer"), "n"
    )


def _level(turns: DataFrame, members: DataFrame, offset: int, columns: int, slice_rows: int) -> tuple[DataFrame, DataFrame]:
    """The nodes deeper than ``offset``, and ``(grp, saved, leaves, children)`` of the nodes at ``offset``."""
    heads = stored(_heads(turns, members, offset, columns), f"matrix{offset}")
    more, below = None, None
    if not heads.where("longer").isEmpty():
        turns = stored(turns.where(F.col("pos") >= offset + columns), f"turns{offset}")
        path = F.md5(F.array_join(F.transform("ids", lambda x: F.hex(x)), ""))
        full = heads.where(F.size("ids") == columns).select("grp", "conv_id", "longer", "n", path.alias("_path"))
        ends = full.groupBy("grp", "_path").agg(F.min("conv_id").alias("_node"), F.count_if("longer").alias("_longer")).where("_longer > 0")
        deeper = stored(full.where("longer").join(ends, ["grp", "_path"]).select(F.col("_node").alias("grp"), "conv_id", "n", "_longer"), f"deeper{offset}")
        alone = deeper.where("_longer = 1")
        more = turns.join(alone, "conv_id").select(
            "grp", "conv_id", (F.col("pos") + 1).alias("depth"), F.when(F.col("pos") == offset + columns, F.col("grp")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
            F.lit(1).cast("long").alias("n_convs"), (F.col("pos") + 1 < F.col("n")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
            F.lit(0).cast("long").alias("saved_tokens"), F.when(F.col("pos") + 1 < F.col("n"), F.lit(NO_ENDS)).otherwise(F.sha2(F.col("conv_id").cast("string"), 256)).alias("ends_sha256"),
        ).drop("grp")
        below = alone.select("grp", F.lit(0).cast("long").alias("saved"), F.lit(1).cast("long").alias("leaves"), F.lit(1).cast("long").alias("children"))
        shared = deeper.where("_longer > 1").drop("_longer")
        if not shared.isEmpty():
            nodes, top = _level(turns, shared, offset + columns, columns, slice_rows)
            more, below = more.unionByName(nodes), below.unionByName(top)
    rows = heads.drop("n")
    if below is None:
        rows = rows.withColumns({c: F.lit(0).cast("long") for c in ("saved", "leaves", "children")})
    else:
        # What lies below a node counts once, in the row of the node's smallest member.
        rows = rows.join(below.withColumnRenamed("grp", "_node"), (F.col("conv_id") == F.col("_node")) & (F.size("ids") == columns), "left").drop("_node")
        rows = rows.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("saved", "leaves", "children")})
    nodes = stored(_matrix_nodes(rows, slice_rows), f"nodes{offset}")
    top = nodes.where("depth = 0").select("grp", F.col("saved_tokens").alias("saved"), F.col("n_leaves").alias("leaves"), F.col("n_children").alias("children"))
    if offset:
        nodes = nodes.where("depth > 0").withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.col("grp")).otherwise(F.col("parent_conv_id")))
    nodes = nodes.withColumn("depth", F.col("depth") + offset).select(*RESULT)
    return (nodes if more is None else nodes.unionByName(more.select(*RESULT))), top


def trie_nodes(turns: DataFrame, lengths: DataFrame, *, columns: int = COLUMNS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``RESULT``, one row per node of the trie of the sequences in ``turns`` (``conv_id``, ``pos`` from 0,
    ``id`` binary, ``words``); ``lengths`` (``conv_id``, ``n``) names all conversations, empty ones too."""
    members = lengths.select(F.lit(0).cast("long").alias("grp"), "conv_id", "n")
    return _level(turns, members, 0, columns, slice_rows)[0]


def prefix_trie(conversations: DataFrame, *, columns: int = COLUMNS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The trie of ``conversations`` (``conv_id``, ``turn``, ``role``, ``text``) after each one's first turns are
    replaced by those of the conversation its ids start from, one row per node.

    ``conv_id`` and ``depth`` name a node: the smallest id of the conversations that start with its turns, and
    their number. Turns are ordered by ``turn``, null first; ties by role and text, so repeated rows are turns
    of their own. Null role or text is empty; rows without a ``conv_id`` belong to no conversation and are left out;
    ids below 0 start from a multiple towards 0. A conversation without turns is a member of the root. An empty
    table has no node. Columns with other names are not read.
    """
    turns, lengths = with_shared_turns(placed_turns(conversations))
    return trie_nodes(stored(turns, "rebuilt"), lengths, columns=columns, slice_rows=slice_rows)
