"""Trie of conversation prefixes, built shard by shard from vertical bitmaps.

1. Turns are put in order (null turns first, ties by the digest of role and text) and become 16-byte digests with a
   word count: no text moves. Optionally a conversation's first turns are exchanged for another one's (`rebuilt`).
2. Equal sequences become one class with its least id and its number of copies, so copies are never expanded.
3. Classes are range-partitioned and sorted by their sequence; a task cuts its share into shards of at most
   `SHARD_ROWS` classes or `SHARD_TURNS` turns. A first turn that a third of all conversations share simply spans many
   shards.
4. In a shard the bits of a set stand for its classes by ascending least id. For every (position, turn) there is a bitset
   of the classes that have it, for every length one of the classes that end there, and for every binary digit of the
   number of copies one more. Depth first, a node's bitset is intersected with the postings of the next position, each
   taken from the lowest class not yet placed, so that there is one intersection per child. Bit counts over the digits
   give the members, the lowest bit the least id, the end sets who ends there.
5. Only nodes on the path of a shard's first or last class can lie in several shards. These are added up by a
   digest of their path; where two neighbouring shards share a path, what both counted is taken off again: a child, a
   leaf, and the words below, as running sums along the path.
6. The digest of the ids that end at a node is taken over pieces: ranges of sorted ids are written out as text in
   parallel, then one pass per node reads the pieces in order.

Null role and text become empty. Rows without a conversation id take no part. Repeated rows are turns like any other.
Very long texts only count as words and digests; a conversation is held whole by a task, 20 bytes a turn. Only
`conv_id`, `turn`, `role` and `text` are read. Empty table: empty result, without a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeloom.session import materialize

SHARD_ROWS, SHARD_TURNS = 1024, 1 << 18
PIECE_BYTES = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"

_NODES = (
    "part int, chunk int, node binary, parent binary, depth bigint, conv_id bigint, parent_conv_id bigint,"
    " n_convs bigint, n_children bigint, n_leaves bigint, words bigint, words_here bigint, words_once bigint,"
    " end_class bigint, end_rows bigint, on_first boolean, on_last boolean"
)
_NODE_TYPES = {
    "binary": pa.binary(),
    "boolean": pa.bool_(),
    "int": pa.int32(),
    "bigint": pa.int64(),
}
_NODE_SCHEMA = pa.schema([(n, _NODE_TYPES[t]) for n, t in (c.split() for c in _NODES.split(", "))])


def sequences(turns: DataFrame) -> DataFrame:
    """`conv_id`, `keys`, `words`: each conversation's turns in order as digests and word counts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            "turn",
            F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("key"),
            F.regexp_count(text, F.lit(WORD)).alias("words"),
        ).alias("said"),
    )
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    return ordered.select("conv_id", F.col("said.key").alias("keys"), F.col("said.words").alias("words"))


def rebuilt(conversations: DataFrame, donor: Column, turns: Column, most: int) -> DataFrame:
    """Conversations (`conv_id`, `keys`, `words`) whose first `turns` (`most` at most) turns are those of `donor`.

    A donor with fewer turns gives all, one that does not exist none; the own turns after the first `turns` follow.
    """
    columns = ("keys", "words")
    wanted = conversations.select(donor.alias("donor")).distinct()
    donors = conversations.join(wanted, F.col("conv_id") == F.col("donor")).select(
        "donor", *[F.slice(c, 1, most).alias(f"given_{c}") for c in columns]
    )
    own = conversations.withColumns({"donor": donor, "given": turns.cast("int")})

    def joined(name: str) -> Column:
        given = F.slice(F.coalesce(f"given_{name}", F.slice(name, 1, 0)), F.lit(1), F.col("given"))
        return F.concat(given, F.slice(name, F.col("given") + 1, F.greatest(F.size(name), F.lit(0)))).alias(name)

    return own.join(donors, "donor", "left").select("conv_id", *[joined(c) for c in columns])


def trie_nodes(rows: list[tuple], part: int, chunk: int) -> pa.RecordBatch:
    """Nodes of one shard; `rows` are its classes in order: (keys, words, least id, copies)."""
    by_id = sorted(range(len(rows)), key=lambda i: rows[i][2])
    ranked = [rows[i] for i in by_id]
    first, last = 1 << by_id.index(0), 1 << by_id.index(len(rows) - 1)
    postings, ends, digits = {}, {}, []
    for number, (keys, _, _, copies) in enumerate(ranked):
        bit = 1 << number
        for position, key in enumerate(keys):
            postings[position, key] = postings.get((position, key), 0) | bit
        ends[len(keys)] = ends.get(len(keys), 0) | bit
        for digit in range(copies.bit_length()):
            if digit == len(digits):
                digits.append(0)
            if copies >> digit & 1:
                digits[digit] |= bit
    columns = {name: [] for name in _NODE_SCHEMA.names}
    above, sets = [], []
    stack = [(-1, (1 << len(rows)) - 1, 0)]
    while stack:
        parent, members, depth = stack.pop()
        least = (members & -members).bit_length() - 1
        keys, words, conv_id, _ = ranked[least]
        here = len(sets)
        sets.append(members)
        above.append(parent)
        count = sum((members & plane).bit_count() << digit for digit, plane in enumerate(digits))
        once = words[depth - 1] if depth else 0
        edge = bool(members & (first | last))
        path = None
        if edge:
            path = hashlib.md5(columns["node"][parent] + keys[depth - 1]).digest() if depth else bytes(16)
        ending = members & ends.get(depth, 0)
        end = ranked[ending.bit_length() - 1] if ending else (None, None, None, 0)
        children, rest = 0, members ^ ending
        while rest:
            low = (rest & -rest).bit_length() - 1
            child = rest & postings[depth, ranked[low][0][depth]]
            rest ^= child
            children += 1
            stack.append((here, child, depth + 1))
        values = {
            "part": part, "chunk": chunk, "node": path, "depth": depth, "conv_id": conv_id, "n_convs": count,
            "parent": columns["node"][parent] if depth else None,
            "parent_conv_id": columns["conv_id"][parent] if depth and columns["node"][parent] is None else None,
            "n_children": children, "n_leaves": int(not children), "words": count * once, "words_here": once,
            "words_once": once, "end_class": end[2], "end_rows": end[3],
            "on_first": bool(members & first), "on_last": bool(members & last),
        }
        for name, value in values.items():
            columns[name].append(value)
    for node in range(len(sets) - 1, 0, -1):
        for name in ("n_leaves", "words", "words_once"):
            columns[name][above[node]] += columns[name][node]
    return pa.RecordBatch.from_pydict(columns, schema=_NODE_SCHEMA)


def _sharder(most_rows: int, most_turns: int):
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, rows, turns = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            columns = [batch.column(c) for c in ("keys", "words", "conv_id", "copies")]
            for i in range(batch.num_rows):
                row = tuple(column[i].as_py() for column in columns)
                if rows and (len(rows) == most_rows or turns + len(row[0]) > most_turns):
                    yield trie_nodes(rows, part, chunk)
                    chunk, rows, turns = chunk + 1, [], 0
                rows.append(row)
                turns += len(row[0])
        if rows:
            yield trie_nodes(rows, part, chunk)

    return shards


def _numbered_shards(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """`edges` with the number of their shard in the order of all; the driver sees one row per task."""
    counts = edges.filter("depth = 0").groupBy("part").agg(F.max("chunk").alias("last")).orderBy("part").collect()
    offsets, total = [], 0
    for row in counts:
        offsets.append((row.part, total))
        total += row.last + 1
    offset = F.broadcast(spark.createDataFrame(offsets, "part int, offset bigint"))
    return edges.join(offset, "part").withColumn("shard", F.col("offset") + F.col("chunk"))


def _merged(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Nodes on the edges of shards, each once, over all shards that hold it."""
    edges = _numbered_shards(spark, edges)
    left = edges.filter("on_last").select("shard", "node", "depth", "n_children", "words_here")
    right = edges.filter("on_first").select((F.col("shard") - 1).alias("shard"), "node")
    upward = Window.partitionBy("shard").orderBy(F.col("depth").desc())
    twice = left.join(right, ["shard", "node"]).select(
        "node",
        F.when(F.row_number().over(upward) > 1, 1).otherwise(0).alias("children_twice"),
        F.when(F.first("n_children").over(upward) == 0, 1).otherwise(0).alias("leaves_twice"),
        F.sum("words_here").over(upward.rowsBetween(Window.unboundedPreceding, 0)).alias("words_twice"),
    )
    kinds = ("children", "leaves", "words")
    twice = twice.groupBy("node").agg(*[F.sum(f"{k}_twice").alias(f"{k}_twice") for k in kinds])
    summed = edges.groupBy("node").agg(
        F.first("depth").alias("depth"),
        F.first("parent").alias("parent"),
        F.min("conv_id").alias("conv_id"),
        F.max("end_class").alias("end_class"),
        F.max("end_rows").alias("end_rows"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "words", "words_once")],
    )

    def without(column: str, kind: str) -> Column:
        return F.col(column) - F.coalesce(f"{kind}_twice", F.lit(0))

    return summed.join(twice, "node", "left").withColumns(
        {
            "n_children": without("n_children", "children"),
            "n_leaves": without("n_leaves", "leaves"),
            "words_once": without("words_once", "words"),
        }
    )


def _piecer(most_bytes: int):
    """Sorted (class, id) rows as text: ids of one class joined by commas, about `most_bytes` at a time."""

    def pieces(batches):
        at, begin, ids, size = None, None, [], 0

        def piece():
            return pa.RecordBatch.from_pydict(
                {"end_class": pa.array([at], pa.int64()), "begin": pa.array([begin], pa.int64()), "ids": [",".join(ids)]}
            )

        for batch in batches:
            for key, conv_id in zip(*(batch.column(c).to_pylist() for c in ("end_class", "conv_id")), strict=True):
                if ids and (key != at or size > most_bytes):
                    yield piece()
                    ids, size = [], 0
                if not ids:
                    at, begin = key, conv_id
                ids.append(str(conv_id))
                size += len(ids[-1]) + 1
        if ids:
            yield piece()

    return pieces


def _digests(batches):
    """One digest per class over its pieces, which come in order."""
    at, digest = None, None

    def found():
        return pa.RecordBatch.from_pydict({"end_class": pa.array([at], pa.int64()), "digest": [digest.hexdigest()]})

    for batch in batches:
        for key, ids in zip(batch.column("end_class").to_pylist(), batch.column("ids"), strict=True):
            if digest is not None and key == at:
                digest.update(b",")
            else:
                if digest is not None:
                    yield found()
                at, digest = key, hashlib.sha256()
            digest.update(ids.as_py().encode())
    if digest is not None:
        yield found()


def _end_digests(members: DataFrame, classes: DataFrame) -> DataFrame:
    """`end_class`, `digest` of the classes with several copies."""
    several = classes.filter("copies > 1").select("class", F.col("conv_id").alias("end_class"))
    rows = members.join(several, "class").select("end_class", "conv_id")
    ranged = rows.repartitionByRange("end_class", "conv_id").sortWithinPartitions("end_class", "conv_id")
    pieces = ranged.mapInArrow(_piecer(PIECE_BYTES), "end_class bigint, begin bigint, ids string")
    together = pieces.repartition("end_class").sortWithinPartitions("end_class", "begin")
    return together.mapInArrow(_digests, "end_class bigint, digest string")


def prefix_trie(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """A row per node of the trie of `conversations` (`conv_id` unique, `keys`, `words`).

    `conv_id` (least member), `depth`, `parent_conv_id`, `n_convs`, `n_children`, `n_leaves`, `saved_tokens` (words below
    that need no second computation, since conversations share them) and `ends_sha256` (ids that end here).
    """
    digest = F.md5(F.array_join(F.transform("keys", F.hex), "")).alias("class")
    rows = materialize(spark, conversations.select("conv_id", "keys", "words", digest), "conversations")
    classes = rows.groupBy("class").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"), F.first("keys").alias("keys"), F.first("words").alias("words")
    )
    classes = materialize(spark, classes, "classes")
    ordered = classes.select("keys", "words", "conv_id", "copies").repartitionByRange("keys").sortWithinPartitions("keys")
    nodes = materialize(spark, ordered.mapInArrow(_sharder(SHARD_ROWS, SHARD_TURNS), _NODES), "nodes")
    merged = materialize(spark, _merged(spark, nodes.filter("node is not null")), "merged")

    facts = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "words", "words_once", "end_class", "end_rows"]
    parents = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    inner = nodes.filter("node is null")
    every = (
        merged.filter("depth = 0").select(*facts, F.lit(None).cast("long").alias("parent_conv_id"))
        .union(merged.filter("depth > 0").join(parents, "parent").select(*facts, "parent_conv_id"))
        .union(inner.filter("parent is not null").drop("parent_conv_id").join(parents, "parent").select(*facts, "parent_conv_id"))
        .union(inner.filter("parent is null").select(*facts, "parent_conv_id"))
    )
    alone = F.sha2(F.coalesce(F.col("end_class").cast("string"), F.lit("")), 256)
    digests = _end_digests(rows.select("class", "conv_id"), classes)
    ended = every.filter("end_rows < 2").withColumn("digest", alone)
    ended = ended.unionByName(every.filter("end_rows > 1").join(digests, "end_class"))
    return ended.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("words") - F.col("words_once")).alias("saved_tokens"),
        F.col("digest").alias("ends_sha256"),
    )
