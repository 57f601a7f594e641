"""Language-model scores of whole texts by a weighted backoff automaton.

The model is an n-gram model with Dirichlet smoothing, learned from the training rows:

    p(w)     = (c(w) + 1) / (N + V + 1)
    p(w | h) = (c(h w) + prior * p(w | h')) / (c(h) + prior),  h' being h without its first word

Every n-gram seen in training is a state. An arc leads from the state of `h` to the state of `h w` and
carries log10 p(w | h); the failure arc from `h` to `h'` carries log10(prior / (c(h) + prior)). Reading a
text left to right carries the state, follows failure arcs until an arc for the next word exists, and
adds up what the arcs carry.

The model grows with the corpus, so no task and no broadcast holds it. Documents are dealt into blocks of
bounded size by a hash of the row. A block sends the hashes of its distinct n-grams with their training
counts, cut into hash ranges; one task per range adds up the counts of all blocks and answers each block
with the totals in the order the block sent its hashes. With these a block builds the part of the
automaton that its own texts can reach, and scores them. An n-gram is moved once per block, not once per
occurrence, so a frequent word or a group of copies costs no more than a rare one.

With more than `FANOUT` blocks the exchange has levels, so that messages grow with the blocks and not with
their square: `FANOUT` blocks are a group, and a task adds up one hash range of one group. What it has
added up is sent on like a block, to tasks that hold a narrower range of `FANOUT` groups, until one group
is left; the totals come back the same way. A task always holds about as many n-grams as a block.

Rows of equal id and text are put together before the deal, some megabytes of rows at a time, and score
once for all: a hot row reaches its block as a few rows with a number of copies.

Null and empty texts are one end token. Copies and repeated rows each get their row and score, null ids
included. Very long texts are read whole, in segments, by one task. Columns other than the id and the text
are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.blobs import pack_planes, pack_sorted, unpack_planes, unpack_sorted
from tapeloom.llm.tokens import all_words, mix, seeds
from tapeloom.session import materialize

BLOCK_BYTES = 8 << 20
FANOUT = 4096
COMBINED_BYTES = 8 << 20
SEGMENT_WORDS = 2048
_BEGIN, _END, _STEP = seeds(3, 101)
_KIND = np.uint64(3)  # the low bits of a hash: order - 1, or 3 for the beginning of a text
_TOP = 1 << 64

SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint,"
    " base_score double, score double"
)


def _grams(text: pa.ChunkedArray, order: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Each text as begin, words, end: bounds of the texts, hashes of the n-grams of each order that end at
    each position, and how many words of its text stand before each position."""
    words, bounds = all_words(text)
    lengths = np.diff(bounds) + 2
    edges = np.concatenate([[0], np.cumsum(lengths)])
    sequence = np.empty(edges[-1], dtype=np.uint64)
    inner = np.ones(edges[-1], dtype=bool)
    inner[edges[:-1]] = inner[edges[1:] - 1] = False
    sequence[inner] = words
    sequence[edges[1:] - 1] = _END
    sequence[edges[:-1]] = _BEGIN
    depth = np.arange(edges[-1]) - np.repeat(edges[:-1], lengths)
    grams = [sequence & ~_KIND]
    grams[0][edges[:-1]] |= _KIND
    for k in range(1, order):
        longer = np.zeros_like(sequence)
        longer[1:] = mix(grams[-1][:-1] * _STEP + sequence[1:])
        grams.append((longer & ~_KIND) | np.uint64(k))
    return edges, grams, depth


def _distinct(grams: list[np.ndarray], depth: np.ndarray) -> np.ndarray:
    return np.unique(np.concatenate([g[depth >= k] for k, g in enumerate(grams)]))


def _combine(batches):
    """Rows of equal id and text as one row with their number, `COMBINED_BYTES` of rows at a time."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= COMBINED_BYTES:
            yield from _combined(held)
            held, size = [], 0
    if held:
        yield from _combined(held)


def _combined(batches):
    keys = ["doc_id", "held_out", "text"]
    rows = pa.Table.from_batches(batches).group_by(keys, use_threads=False).aggregate([([], "count_all")])
    yield from rows.select([*keys, "count_all"]).rename_columns([*keys, "copies"]).to_batches()


def _cuts(values: np.ndarray, part: int, parts: int, ways: int) -> list[int]:
    """Where ascending hashes, all in range `part` of `parts` equal ones, pass into each of its `ways` subranges."""
    first = [_TOP * (part * ways + r) // (parts * ways) for r in range(1, ways)]
    return [0, *(int(np.searchsorted(values, np.uint64(x))) for x in first), len(values)]


def _messages(known: np.ndarray, counts: np.ndarray, sender: int, part: int, parts: int, ways: int, fanout: int) -> pa.Table:
    """What a block, or a task that holds range `part` of a group, sends on: a row for each of `ways` subranges."""
    cuts = _cuts(known, part, parts, ways)
    # Empty ranges are sent, too: each answer carries its range's share of the token and type counts.
    return pa.table(
        {
            "group": pa.array([sender // fanout] * ways, pa.int64()),
            "part": pa.array([part * ways + r for r in range(ways)], pa.int64()),
            "sender": pa.array([sender] * ways, pa.int64()),
            "grams": pa.array([pack_sorted(known[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
            "counts": pa.array([pack_planes(counts[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
        }
    )


MESSAGES = "group bigint, part bigint, sender bigint, grams binary, counts binary"
ANSWERS = "sender bigint, part bigint, totals binary, tokens bigint, types bigint"


def _count_block(order: int, ways: int, fanout: int):
    def count(table: pa.Table) -> pa.Table:
        edges, grams, depth = _grams(table.column("text"), order)
        known = _distinct(grams, depth)
        lengths = np.diff(edges)
        training = np.repeat(~table.column("held_out").to_numpy(), lengths)
        copies = np.repeat(table.column("copies").to_numpy(), lengths)
        counts = np.zeros(len(known), dtype=np.uint64)
        seen, times = np.unique(
            np.concatenate([g[(depth >= k) & training] for k, g in enumerate(grams)]), return_counts=True
        )
        counts[np.searchsorted(known, seen)] = times
        more = training & (copies > 1)
        if more.any():
            again = np.concatenate([g[(depth >= k) & more] for k, g in enumerate(grams)])
            times = np.concatenate([copies[(depth >= k) & more] for k in range(order)]) - 1
            np.add.at(counts, np.searchsorted(known, again), times.astype(np.uint64))
        return _messages(known, counts, table.column("block")[0].as_py(), 0, 1, ways, fanout)

    return count


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The n-grams of all messages, their counts added up, and the place of each message's n-grams among them."""
    grams = [unpack_sorted(x.as_buffer()) for x in table.column("grams")]
    counts = [unpack_planes(x.as_buffer(), np.uint64) for x in table.column("counts")]
    known, place = np.unique(np.concatenate(grams), return_inverse=True)
    totals = np.bincount(place, weights=np.concatenate(counts), minlength=len(known)).astype(np.uint64)
    return known, totals, np.split(place, np.cumsum([len(g) for g in grams])[:-1])


def _send_on(parts: int, ways: int, fanout: int):
    def send(table: pa.Table) -> pa.Table:
        known, totals, _ = _merged(table)
        return _messages(known, totals, table.column("group")[0].as_py(), table.column("part")[0].as_py(), parts, ways, fanout)

    return send


def _answers(messages: pa.Table, places: list[np.ndarray], totals: np.ndarray, tokens: int, types: int) -> pa.Table:
    """Totals of one hash range, in each sender's own order."""
    return pa.table(
        {
            "sender": messages.column("sender"),
            "part": messages.column("part"),
            "totals": pa.array([pack_planes(totals[p]) for p in places], pa.binary()),
            "tokens": pa.array([tokens] * len(places), pa.int64()),
            "types": pa.array([types] * len(places), pa.int64()),
        }
    )


def _add_up(table: pa.Table) -> pa.Table:
    known, totals, places = _merged(table)
    words = totals[(known & _KIND) == 0]
    return _answers(table, places, totals, int(words.sum()), int((words > 0).sum()))


def _pass_back(messages: pa.Table, answers: pa.Table) -> pa.Table:
    return _answers(messages, _merged(messages)[2], *_joined(answers))


def _joined(answers: pa.Table) -> tuple[np.ndarray, int, int]:
    """The totals of all ranges in order, and the token and type counts they carry."""
    answers = answers.sort_by("part")
    totals = np.concatenate([unpack_planes(x.as_buffer(), np.uint64) for x in answers.column("totals")])
    tokens, types = (int(answers.column(c).to_numpy().sum()) for c in ("tokens", "types"))
    return totals, tokens, types


def exchange_ways(blocks: int, fanout: int) -> list[int]:
    """Into how many subranges each level of the exchange cuts a range: one level for `fanout` blocks."""
    ways = []
    while blocks > fanout:
        ways.append(fanout)
        blocks = -(-blocks // fanout)
    return [*ways, blocks]


def _exchange(dealt: DataFrame, blocks: int, order: int, fanout: int) -> DataFrame:
    """`ANSWERS` for each block (`sender`): a row per range with the totals of the block's n-grams in it."""
    ways = exchange_ways(blocks, fanout)
    levels = [dealt.groupBy("block").applyInArrow(_count_block(order, ways[0], fanout), MESSAGES)]
    parts = ways[0]
    for more in ways[1:]:
        # Stored, since the way back needs the messages once more.
        levels[-1] = materialize(dealt.sparkSession, levels[-1], "lm-messages")
        levels.append(levels[-1].groupBy("group", "part").applyInArrow(_send_on(parts, more, fanout), MESSAGES))
        parts *= more
    answers = levels[-1].groupBy("group", "part").applyInArrow(_add_up, ANSWERS)
    for messages, more in zip(reversed(levels[:-1]), reversed(ways[1:]), strict=True):
        holder = F.floor(F.col("part") / more).cast("long")
        answers = (
            messages.groupBy("group", "part")
            .cogroup(answers.groupBy(F.col("sender").alias("group"), holder.alias("part")))
            .applyInArrow(_pass_back, ANSWERS)
        )
    return answers


class _Automaton:
    """The states and arcs that the texts of one block can reach.

    `nodes[k]` names, at each position, the state of the n-gram of order k + 1 that ends there, or -1.
    """

    def __init__(self, edges, grams, depth, known, totals, tokens, types, prior):
        seen = totals > 0
        known, counts = known[seen], totals[seen].astype(np.float64)
        self.edges, self.depth = edges, depth
        self.nodes = []
        for k, g in enumerate(grams):
            place = np.minimum(np.searchsorted(known, g), max(len(known) - 1, 0))
            found = (known[place] == g) & (depth >= k) if len(known) else np.zeros(len(g), dtype=bool)
            self.nodes.append(np.where(found, place, -1))
        self.failure = np.log10(prior / (counts + prior))
        self.arc = np.zeros(len(known))
        self.unknown = -math.log10(tokens + types + 1)
        count_at = lambda k: np.where(self.nodes[k] >= 0, counts[self.nodes[k]] if len(counts) else 0.0, 0.0)
        self.words = count_at(0)
        lower = (self.words + 1) / (tokens + types + 1)
        self._set(0, lower)
        for k in range(1, len(grams)):
            context = np.concatenate([[0.0], count_at(k - 1)[:-1]])
            lower = (count_at(k) + prior * lower) / (context + prior)
            self._set(k, lower)

    def _set(self, k, probability):
        here = self.nodes[k] >= 0
        self.arc[self.nodes[k][here]] = np.log10(probability[here])

    def scores(self) -> np.ndarray:
        """Log10 probability of each text. Texts are read side by side, a long one in segments: a state holds
        at most the last words, so reading those words again restores it."""
        order = len(self.nodes)
        lengths = np.diff(self.edges) - 1
        segments = -(-lengths // SEGMENT_WORDS)
        text = np.repeat(np.arange(len(lengths)), segments)
        number = np.arange(len(text)) - np.repeat(np.cumsum(segments) - segments, segments)
        begin = self.edges[text] + 1 + number * SEGMENT_WORDS
        stop = np.minimum(begin + SEGMENT_WORDS, self.edges[text + 1])
        longest = np.argsort(begin - stop, kind="stable")
        text, begin, stop = text[longest], begin[longest], stop[longest]
        added = np.zeros(len(text))
        state = self._state_before(begin, order)
        for step in range(int((stop - begin).max(initial=0))):
            width = int(np.searchsorted(begin - stop, -step, side="left"))
            at, state = begin[:width] + step, state[:width]
            weight, state = self._read(at, state, order)
            added[:width] += weight
        return np.bincount(text, weights=added, minlength=len(lengths))

    def _state_before(self, at, order):
        """Length of the longest history that is a state."""
        state = np.zeros(len(at), dtype=np.int64)
        for k in range(order - 1):
            state = np.where(self.nodes[k][at - 1] >= 0, k + 1, state)
        return state

    def _read(self, at, state, order):
        weight = np.zeros(len(at))
        target = np.full(len(at), -1)
        for k in range(order - 1, -1, -1):
            trying = (target < 0) & (state == k)
            node = np.where(trying, self.nodes[k][at], -1)
            target = np.where(node >= 0, node, target)
            failed = trying & (node < 0)
            if k:
                weight[failed] += self.failure[self.nodes[k - 1][at[failed] - 1]]
            else:
                weight[failed] += self.unknown
            reached = np.where(node >= 0, k + 1, 0)
            after = reached if k == order - 1 else np.maximum(after, reached)
            state = np.where(failed, k - 1, state)
        found = target >= 0
        weight[found] += self.arc[target[found]]
        return weight, np.minimum(after, order - 1)


def _score_block(order: int, prior: float):
    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        empty = pa.schema(
            [("doc_id", pa.int64()), ("held_out", pa.bool_())]
            + [(name, pa.int64()) for name in ("n_tokens", "n_known", "train_tokens")]
            + [("base_score", pa.float64()), ("score", pa.float64()), ("copies", pa.int64())]
        )
        if not docs.num_rows:
            return empty.empty_table()
        edges, grams, depth = _grams(docs.column("text"), order)
        totals, tokens, types = _joined(answers)
        machine = _Automaton(edges, grams, depth, _distinct(grams, depth), totals, tokens, types, prior)
        inside = depth > 0
        owner = np.repeat(np.arange(docs.num_rows), np.diff(edges))[inside]
        words = machine.words[inside]
        base = np.bincount(owner, weights=np.log10(words + 1), minlength=docs.num_rows)
        n_tokens = np.diff(edges) - 1
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "held_out": docs.column("held_out"),
                "n_tokens": n_tokens,
                "n_known": np.bincount(owner, weights=words > 0, minlength=docs.num_rows).astype(np.int64),
                "train_tokens": np.full(docs.num_rows, tokens),
                "base_score": base - n_tokens * math.log10(tokens + types + 1),
                "score": machine.scores(),
                "copies": docs.column("copies"),
            },
            schema=empty,
        )

    return score


def text_blocks(docs: DataFrame, block_bytes: int) -> int:
    """Number of blocks of about `block_bytes` of text: one aggregate over the lengths."""
    total = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))).first()[0] or 0
    return int(max(1, -(-total // block_bytes)))


def score_texts(
    docs: DataFrame,
    held_out: Column,
    *,
    order: int = 2,
    prior: float = 100.0,
    block_bytes: int = BLOCK_BYTES,
    fanout: int = FANOUT,
) -> DataFrame:
    """Scores of the texts of `docs` (`doc_id`, `text`) by a model learned from rows that aren't `held_out`.

    `order` is the longest n-gram, `prior` the weight of the shorter history, `block_bytes` the text one
    task holds, `fanout` the blocks of a group. Gives the columns of `SCORES`, a row for each row of `docs`.
    """
    blocks = text_blocks(docs, block_bytes)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    dealt = rows.mapInArrow(_combine, "doc_id bigint, held_out boolean, text string, copies bigint").withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("long")
    )
    answers = _exchange(dealt, blocks, order, fanout)
    scored = dealt.groupBy("block").cogroup(answers.groupBy("sender")).applyInArrow(
        _score_block(order, prior), f"{SCORES}, copies bigint"
    )
    return scored.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies", "col")
