"""Benchmark decontamination by template canonicalisation.

Texts become templates: words between white space and punctuation, lower-cased, in which numbers, names
(capitalised words inside a sentence) and units (after a number) are replaced by typed placeholders; the
replaced words are the slots. Windows of `WINDOW` template words of documents and benchmark items are
joined by hash. Of each document and item, windows at the same distance are one alignment, and an
alignment counts if its names are consistent: one benchmark name always stands for one document name. Equal
numbers and units may be exchanged for different ones. Where names conflict, the windows that agree with the
most frequent name of each count, if they are four fifths of the alignment's windows or more.
A document is leaked if alignments hold `RUN` windows of an item (13 words), or four fifths of the
windows of a shorter one; it is re-parameterised if values were exchanged.

A template's windows are evidence if they have `LITERALS` words that aren't placeholders. Every text is read in
three ways, each judged for itself: names inside sentences only; capitalised words that open a sentence as names
too; and all windows as their plain lower-cased words, so that copies in any letter case, and of number-heavy items, are
found. Items of fewer than `LITERALS` words cannot be found. A bit filter of fixed size, built from all benchmark windows, thins out the document windows
before the join; it loses none and only saves work. The benchmark's windows are broadcast while few, and
joined by a shuffle beyond.

Null and empty texts hold no windows: never leaked. Items with a null id or text are skipped. Null ids and
repeated rows are judged each by its text. Other columns are kept, but for those named as the columns that
are added, which are replaced. No benchmark: nothing is leaked. No documents: empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm.mixing import small
from tapeloom.llm.tokens import PIECE_BYTES, hash_words, mix, seeds, signed, text_bytes
from tapeloom.session import materialize

WINDOW, LITERALS, RUN = 8, 5, 6
INSIDE, OPENING, PLAIN = 0, 1, 2  # ways of reading
NUMBER_KIND, NAME_KIND, UNIT_KIND = 1, 2, 3  # lowest bits of a slot's value
FILTER_BITS = 1 << 22

# Units that follow a number, and numbers in words.
UNITS = (
    "mm cm m km in ft mi mg g kg lb oz ml l s min h hr hrs kb mb gb hz khz mhz ghz w kw v kv j kj k c f usd eur gbp"
    " percent dollars dollar euros euro cents cent years year months month weeks week days day hours hour minutes"
    " minute seconds second meters meter metres metre kilometers kilometer kilometres kilometre miles mile feet foot"
    " inches inch pounds pound grams gram kilograms kilogram liters liter litres litre degrees degree"
).split()
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    " eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million"
).split()

_OUTSIDE = np.zeros(256, dtype=bool)
_OUTSIDE[:0x80] = [not chr(b).isalnum() for b in range(0x80)]
_DIGIT = np.zeros(257, dtype=bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_BREAK = np.zeros(256, dtype=np.int64)
_BREAK[[ord(c) for c in ".!?\n"]] = 1
_NUMBER, _NAME, _UNIT, _STEP, _BITS = seeds(5, 909)


def _hashes(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    return np.sort(hash_words(data, np.array([0, len(data)]))[0])


_UNIT_WORDS, _NUMBER_WORDS = _hashes(UNITS), _hashes(NUMBER_WORDS)


def _member(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def templates(data: np.ndarray, bounds: np.ndarray, opening: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template words and the words they stand for (0: itself) of each text, and each text's bounds in them.

    `opening`: capitalised words that open a sentence are names.
    """
    words, starts, ends, edges = hash_words(data, bounds, _OUTSIDE)
    if not len(words):
        return words, words, edges
    first = np.zeros(len(words), dtype=bool)
    first[edges[:-1][edges[:-1] < edges[1:]]] = True
    digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
    number = (digits[ends] - digits[starts] == ends - starts) | _member(words, _NUMBER_WORDS)
    # 3.5 and 1,000 are one number: what follows the mark is dropped, its value goes into the first part's.
    joined = np.zeros(len(words), dtype=bool)
    joined[1:] = number[1:] & number[:-1] & (starts[1:] == ends[:-1] + 1) & ~first[1:]
    joined[1:] &= np.isin(data[np.minimum(ends[:-1], len(data) - 1)], [ord("."), ord(",")])
    breaks = np.concatenate([[0], np.cumsum(_BREAK[data])])
    opens = first.copy()
    opens[1:] |= breaks[starts[1:]] > breaks[ends[:-1]]
    lead, second = data[starts], data[np.minimum(starts + 1, len(data) - 1)]
    accented = (lead == 0xC3) & (second >= 0x80) & (second <= 0x9E)
    capital = (lead >= ord("A")) & (lead <= ord("Z")) & (ends - starts > 1) & ~((second >= ord("A")) & (second <= ord("Z")))
    name = (capital | accented) & ~number
    if not opening:
        name &= ~opens
    unit = np.zeros(len(words), dtype=bool)
    unit[1:] = number[:-1] & _member(words[1:], _UNIT_WORDS) & ~first[1:]
    slot = number | name | unit
    template = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, words)))
    values = np.where(slot, words, np.uint64(0))
    parts = np.flatnonzero(joined)
    for i in parts[::-1]:
        values[i - 1] = mix(values[i - 1 : i] * _STEP + values[i])[0]
    kind = np.where(number, NUMBER_KIND, np.where(unit, UNIT_KIND, NAME_KIND)).astype(np.uint64)
    values = np.where(slot, (values & ~np.uint64(3)) | kind, values)
    kept = ~joined
    return template[kept], values[kept], np.concatenate([[0], np.cumsum(kept)])[edges]


def windows(template: np.ndarray, values: np.ndarray, edges: np.ndarray, lengths: list[int], reading: int = INSIDE):
    """Per length: hash of each window that is evidence, its first word, and its text."""
    # The plain words, without what tells a slot's kind.
    plain = np.where(values == 0, template, values) & ~np.uint64(3)
    literal = np.concatenate([[0], np.cumsum(values == 0)])
    for length in lengths:
        if len(template) < length:
            continue
        last = len(template) - length + 1
        hashes = _window_hashes(plain if reading == PLAIN else template, length)
        text = np.searchsorted(edges, np.arange(last), "right") - 1
        good = (literal[length : length + last] - literal[:last] >= LITERALS) | (reading == PLAIN)
        good &= np.arange(last) + length <= edges[text + 1]
        at = np.flatnonzero(good)
        yield length, mix(hashes[at] + np.uint64(length + (reading << 8))), at, text[at]


def _window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    last = len(words) - length + 1
    hashes = words[:last].copy()
    for j in range(1, length):
        hashes = mix(hashes * _STEP + words[j : j + last])
    return hashes


def _emit(lengths: list[int], keys: list[str], fields, bits: np.ndarray | None):
    """Windows of each row with its key columns; with `bits`, only those that pass the filter."""

    def emit(batches):
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            row = 0
            while row < batch.num_rows:
                end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + PIECE_BYTES, side="right")) - 1)
                part = bounds[row : end + 1]
                found = []
                with np.errstate(over="ignore"):
                    inside, opening = (templates(data[part[0] : part[-1]], part - part[0], o) for o in (False, True))
                    for reading, read in ((INSIDE, inside), (OPENING, opening), (PLAIN, inside)):
                        # Plain windows have no slots: what they match is equal.
                        slots = np.zeros_like(read[1]) if reading == PLAIN else read[1]
                        found += [(reading, slots, read[2], *w) for w in windows(*read, lengths, reading)]
                for reading, values, edges, length, hashes, at, text in found:
                    if bits is not None:
                        place = (hashes % np.uint64(FILTER_BITS)).astype(np.int64)
                        passed = (bits[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) > 0
                        hashes, at, text = hashes[passed], at[passed], text[passed]
                    slots = signed(values)[at[:, None] + np.arange(length)]
                    columns = [batch.column(k).take(pa.array(row + text)) for k in keys]
                    columns += [pa.array(np.full(len(at), reading, dtype=np.int32))]
                    columns += [pa.array(signed(hashes)), pa.array(at - edges[text])]
                    offsets = np.arange(len(at) + 1, dtype=np.int32) * length
                    columns += [pa.ListArray.from_arrays(pa.array(offsets), pa.array(slots.reshape(-1)))]
                    yield pa.RecordBatch.from_arrays(columns, names=[*keys, *fields])
                row = end

    return emit


def item_windows(benchmark: DataFrame) -> DataFrame:
    """`item_id`, `reading`, `hash`, `item_at`, `item_slots`, `needed` of all benchmark windows."""
    items = benchmark.filter("item_id is not null and text is not null").select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    )
    found = items.mapInArrow(
        _emit(list(range(LITERALS, WINDOW + 1)), ["item_id"], ["reading", "hash", "item_at", "item_slots"], None),
        "item_id bigint, reading int, hash bigint, item_at bigint, item_slots array<bigint>",
    ).dropDuplicates(["item_id", "hash", "item_at"])
    longest = found.groupBy("item_id", "reading").agg(F.max(F.size("item_slots")).alias("length"))
    counted = found.join(longest, ["item_id", "reading"]).filter(F.size("item_slots") == F.col("length"))
    total = counted.groupBy("item_id", "reading").agg(F.count("*").alias("n"))
    needed = F.least(F.lit(RUN), F.ceil(F.col("n") * 0.8)).cast("long")
    return counted.join(total.select("item_id", "reading", needed.alias("needed")), ["item_id", "reading"])


def _filter_bits(items: DataFrame) -> np.ndarray:
    place = F.col("hash").bitwiseAND(F.lit(FILTER_BITS - 1))
    word, bit = F.shiftright(place, 6), F.pmod(place, F.lit(64)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    words = items.groupBy(word.alias("word")).agg(F.bit_or(one).alias("bits"))
    rows = words.toPandas()  # one row per 64 bits of the filter at most
    bits = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    bits[rows["word"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return bits


# The windows of an alignment whose names all stand for what their benchmark name stands for most often.
_AGREEING = """CASE WHEN size(array_distinct(names.was)) = size(array_distinct(transform(names, p -> struct(p.was, p.now))))
    THEN held ELSE aggregate(array(map_from_entries(transform(array_distinct(names.was), w -> struct(w, array_max(
        transform(filter(names, p -> p.was = w), p -> struct(
            size(filter(names, q -> q.was = w and q.now = p.now)) AS n, p.now = w AS same, p.now AS now))).now)))),
        held, (h, most) -> filter(h, v -> forall(v.pairs, p -> (p.was & 3L) <> 2L or p.now = most[p.was]))) END"""


def leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`dec_row` (hash of id and text), `items`, `matched_windows`, `reparameterised` of each leaked text."""
    items = materialize(spark, item_windows(benchmark), "item-windows")
    lengths = sorted(r.length for r in items.select(F.size("item_slots").alias("length")).distinct().collect())
    found = docs.select(row_key().alias("dec_row"), "text").mapInArrow(
        _emit(lengths, ["dec_row"], ["doc_reading", "hash", "at", "slots"], _filter_bits(items)),
        "dec_row bigint, doc_reading int, hash bigint, at bigint, slots array<bigint>",
    )
    hits = found.join(small(items), "hash").filter("size(slots) = size(item_slots) and doc_reading = reading")
    exchanged = F.expr(
        """filter(transform(arrays_zip(item_slots, slots), (p, i) -> named_struct('at', item_at + i, 'was', p.item_slots, 'now', p.slots)),
        p -> p.was <> 0 or p.now <> 0)"""
    )
    aligned = (
        hits.select(
            "dec_row", "item_id", "reading", "needed", "item_at", (F.col("at") - F.col("item_at")).alias("shift"), exchanged.alias("pairs")
        )
        .groupBy("dec_row", "item_id", "reading", "shift")
        .agg(F.first("needed").alias("needed"), F.collect_set(F.struct("item_at", "pairs")).alias("held"))
        .withColumn("names", F.expr(f"filter(array_distinct(flatten(held.pairs)), p -> (p.was & 3L) = {NAME_KIND})"))
        .withColumn("kept", F.expr(_AGREEING))
        .filter("5 * size(kept) >= 4 * size(held)")
    )
    changed = F.exists(F.flatten("kept.pairs"), lambda p: p["was"] != p["now"])
    per_reading = (
        aligned.groupBy("dec_row", "item_id", "reading")
        .agg(F.sum(F.size("kept")).alias("windows"), F.first("needed").alias("needed"), F.max(changed).alias("changed"))
        .filter("windows >= needed")
    )
    # The first reading that finds the item tells whether values were exchanged: a verbatim copy has none in any.
    per_item = per_reading.groupBy("dec_row", "item_id").agg(
        F.max("windows").alias("windows"), F.min_by("changed", "reading").alias("changed")
    )
    return per_item.groupBy("dec_row").agg(
        F.sort_array(F.collect_list("item_id")).alias("items"),
        F.sum("windows").alias("matched_windows"),
        F.max("changed").alias("reparameterised"),
    )


def row_key():
    return F.xxhash64(F.col("doc_id").cast("string"), F.col("text").cast("string"))


def mark_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` (`doc_id`, `text`, others) with `leaked`, `items`, `matched_windows`, `reparameterised`."""
    found = materialize(spark, leaks(spark, docs, benchmark), "leaks")
    return (
        docs.drop("leaked", "items", "matched_windows", "reparameterised")
        .withColumn("dec_row", row_key())
        .join(small(found), "dec_row", "left")
        .withColumns(
            {
                "leaked": F.col("items").isNotNull(),
                "items": F.coalesce("items", F.array().cast("array<bigint>")),
                "matched_windows": F.coalesce("matched_windows", F.lit(0)),
                "reparameterised": F.coalesce("reparameterised", F.lit(False)),
            }
        )
        .drop("dec_row")
    )
