"""Toxicity scores by gradient-boosted trees over dense features, with isotonic calibration.

Learning takes a sample of labelled rows, at most `sample_rows` of each class, chosen by hash. It is split in
three by hash: one part teaches the lexicon (words, and beginnings of words, that toxic texts have more
often), one grows the trees, one calibrates; so the trees see lexicon hits as unlabelled texts have them.
Negative rows are weighted for what the sample left out. Only text is looked at: labels, ids, languages
and sources are never features.

Features of a text: densities and strengths of lexicon hits (a fixed list, learned words, learned beginnings),
their nearness to second-person words, capitals, punctuation, symbols, and rates of obfuscation (digits and
signs written for letters, spelled-out words, drawn-out letters).

The model is some hundred kilobytes whatever the corpus, and scoring is one pass over all texts, whole.

Null and empty texts have all features zero and get the model's score for that. Rows are scored one by one,
so ties and repeated rows are equal. Labels that are null or neither 0 nor 1 are skipped, an id labelled
twice counts as toxic if one label is. Without labels of both classes the fixed list alone decides. Other
columns are kept, columns named `score` or `predicted` are replaced. Empty table: empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.llm.boosting import BoostedTrees, Isotonic
from tapeloom.llm.tokens import PIECE_BYTES, hash_words, mix, seeds, span_hasher, text_bytes
from tapeloom.session import materialize

SAMPLE_ROWS, LEXICON = 8_000, 4_096
BEGINNINGS = (4, 5, 6)
NEAR = 10
_KINDS = seeds(1 + len(BEGINNINGS), 303)

# Insults, and words that address someone.
INSULTS = (
    "idiot idiots moron morons stupid dumb loser losers trash scum pathetic worthless disgusting clown fool fools ugly"
    " garbage imbecile cretin jerk hate hateful kill die filthy vermin parasite lunatic psycho creep coward liar"
    " crap damn hell bastard bitch asshole shit fuck fucking whore slut"
).split()
SECOND_PERSON = (
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine deiner ihr euch euer eure sie"
    " ti tú usted ustedes vosotros os su sus"
).split()

_LETTERS = np.ones(256, dtype=bool)
_LETTERS[:0x80] = [chr(b).isalpha() for b in range(0x80)]
_WRITTEN_FOR = np.arange(256, dtype=np.uint8)
for _sign, _letter in {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}.items():
    _WRITTEN_FOR[ord(_sign)] = ord(_letter)
_CLASSES = np.zeros((5, 256), dtype=np.int64)
_CLASSES[0, ord("A") : ord("Z") + 1] = 1
_CLASSES[1, ord("!")] = 1
_CLASSES[2, ord("?")] = 1
_CLASSES[3, [ord(c) for c in "*#%&$@^~"]] = 1
_CLASSES[4, ord("0") : ord("9") + 1] = 1


def _words_of(texts: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(texts).encode(), dtype=np.uint8)
    return np.sort(hash_words(data, np.array([0, len(data)]), ~_LETTERS)[0])


_INSULTS, _SECOND = _words_of(INSULTS), _words_of(SECOND_PERSON)


def _place(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Place of each value in a sorted table, or -1."""
    if not len(table):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[at] == values, at, -1)


class Lexicon:
    """Learned units (hashes of words and beginnings, sorted) and their log odds."""

    def __init__(self, units: np.ndarray, weights: np.ndarray):
        order = np.argsort(units)
        self.units, self.weights = units[order], weights[order]

    def weigh(self, units: np.ndarray) -> np.ndarray:
        at = _place(units, self.units)
        return np.where(at >= 0, self.weights[at] if len(self.weights) else 0.0, 0.0)


def _units(data, starts, ends, words) -> list[np.ndarray]:
    """Hash of each word, then of each of its beginnings (0 if it is no longer than that)."""
    result, hashes = [mix(words ^ _KINDS[0])], span_hasher(data)
    for kind, length in zip(_KINDS[1:], BEGINNINGS, strict=True):
        longer = ends - starts > length
        part = hashes(starts, np.minimum(starts + length, ends))
        result.append(np.where(longer, mix(part ^ kind), np.uint64(0)))
    return result


def _pieces(column):
    data, bounds = text_bytes(column)
    row, rows = 0, len(bounds) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + PIECE_BYTES, side="right")) - 1)
        part = bounds[row : end + 1]
        yield row, end, data[part[0] : part[-1]], part - part[0]
        row = end


def _features(data: np.ndarray, bounds: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    words, starts, ends, edges = hash_words(data, bounds, ~_LETTERS)
    rows = len(bounds) - 1
    owner = np.repeat(np.arange(rows), np.diff(edges))
    total = lambda values: np.bincount(owner, weights=values, minlength=rows)
    top = np.zeros((rows, 2))
    units = _units(data, starts, ends, words)
    learned = lexicon.weigh(units[0])
    begins = np.max([lexicon.weigh(u) for u in units[1:]], axis=0) if len(words) else learned
    np.maximum.at(top[:, 0], owner[learned > 0], learned[learned > 0])
    np.maximum.at(top[:, 1], owner[begins > 0], begins[begins > 0])
    insult = _place(words, _INSULTS) >= 0
    hit = insult | (learned > 0) | (begins > 0)
    strong = insult | (learned > 2) | (begins > 2)
    count = np.maximum(np.diff(edges), 1).astype(np.float64)
    size = np.maximum(np.diff(bounds), 1).astype(np.float64)

    second = np.flatnonzero(_place(words, _SECOND) >= 0)
    near = np.zeros(rows)
    at = np.flatnonzero(hit)
    if len(second) and len(at):
        next_ = np.searchsorted(second, at)
        for side in (np.minimum(next_, len(second) - 1), np.maximum(next_ - 1, 0)):
            distance = np.abs(second[side] - at)
            good = (owner[second[side]] == owner[at]) & (distance <= NEAR)
            near += np.bincount(owner[at[good]], weights=1 / (1.0 + distance[good]), minlength=rows)

    sums = np.zeros((len(_CLASSES), len(data) + 1), dtype=np.int64)
    np.cumsum(_CLASSES[:, data], axis=1, out=sums[:, 1:])
    classes = (sums[:, bounds[1:]] - sums[:, bounds[:-1]]) / size
    length = ends - starts
    capitals = (sums[0][ends] - sums[0][starts] == length) & (length > 1)
    single = length == 1
    spelled = np.zeros(len(words))
    spelled[2:] = single[2:] & single[1:-1] & single[:-2] & (owner[2:] == owner[:-2])
    same = np.zeros(len(data) + 1, dtype=np.int64)
    same[3:] = np.cumsum((data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & _LETTERS[data[2:]])
    drawn = same[bounds[1:]] - same[bounds[:-1]]

    disguised = np.zeros(rows)
    plain = _WRITTEN_FOR[data]
    changed = np.flatnonzero(plain != data)
    if len(changed):
        masked, begin, stop, borders = hash_words(plain, bounds, ~_LETTERS)
        touched = np.searchsorted(changed, stop) > np.searchsorted(changed, begin)
        who = np.repeat(np.arange(rows), np.diff(borders))[touched]
        weights = lexicon.weigh(mix(masked[touched] ^ _KINDS[0]))
        disguised = np.bincount(who, weights=(weights > 0) | (_place(masked[touched], _INSULTS) >= 0), minlength=rows)

    hits = [total(x) for x in (insult, learned > 0, begins > 0, strong)]
    return np.column_stack(
        [
            np.log1p(np.diff(edges)),
            *hits,
            *[h / count for h in hits],
            total(learned) / count,
            total(begins) / count,
            top,
            near,
            near / count,
            np.bincount(owner[second], minlength=rows) / count,
            total(capitals) / count,
            classes.T,
            total(spelled) / count,
            drawn / size,
            disguised,
            disguised / count,
            total(length) / count,
        ]
    )


def _feature_rows(column, lexicon):
    with np.errstate(over="ignore"):
        parts = [_features(data, bounds, lexicon) for _, _, data, bounds in _pieces(column)]
    return np.concatenate(parts) if parts else np.zeros((0, 0))


def _count_units(batches):
    """Texts that hold each unit, and toxic ones among them, added up within a batch."""
    for batch in batches:
        toxic = batch.column("toxic").to_numpy()
        found, marks = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
        with np.errstate(over="ignore"):
            for row, _, data, bounds in _pieces(batch.column("text")):
                words, starts, ends, edges = hash_words(data, bounds, ~_LETTERS)
                units = np.stack(_units(data, starts, ends, words))
                for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    own = np.unique(units[:, a:b])
                    found.append(own)
                    marks.append(np.full(len(own), toxic[row + i]))
        units, place = np.unique(np.concatenate(found), return_inverse=True)
        marks = np.concatenate(marks)
        yield pa.RecordBatch.from_pydict(
            {
                "unit": units.view(np.int64),
                "toxic": np.bincount(place, weights=marks, minlength=len(units)).astype(np.int64),
                "texts": np.bincount(place, minlength=len(units)).astype(np.int64),
            }
        )


class ToxicityModel:
    """Lexicon, trees and calibration; `trees` is None without labels of both classes."""

    def __init__(self, lexicon: Lexicon, trees: BoostedTrees | None, calibration: Isotonic | None):
        self.lexicon, self.trees, self.calibration = lexicon, trees, calibration

    def scores(self, column: pa.Array) -> np.ndarray:
        features = _feature_rows(column, self.lexicon)
        if not len(features):
            return np.zeros(0)
        if self.trees is None:
            return 1 / (1 + np.exp(2 - 4 * np.minimum(features[:, 1], 3)))
        margins = self.trees.margins(features)
        return self.calibration.probabilities(margins) if self.calibration else 1 / (1 + np.exp(-margins))


def _learn_lexicon(sample: DataFrame, size: int) -> Lexicon:
    rows = sample.filter("part < 50").select("toxic", "text")
    toxic, texts = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    clean = texts - toxic
    if not toxic or not clean:
        return Lexicon(np.zeros(0, dtype=np.uint64), np.zeros(0))
    counted = rows.mapInArrow(_count_units, "unit bigint, toxic bigint, texts bigint").groupBy("unit").agg(
        F.sum("toxic").alias("t"), (F.sum("texts") - F.sum("toxic")).alias("c")
    )
    odds = F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("c") + 0.5) / (clean + 1.0))
    sure = F.col("odds") / F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    chosen = (
        counted.filter("t >= 2 and unit <> 0")
        .withColumn("odds", odds)
        .withColumn("sure", sure)
        .filter("sure > 2")
        .orderBy(F.desc("sure"), "unit")
        .limit(size)
        .select("unit", "odds")
        .toPandas()
    )
    return Lexicon(chosen["unit"].to_numpy(dtype=np.int64).view(np.uint64), chosen["odds"].to_numpy(dtype=np.float64))


def _with_features(lexicon: Lexicon):
    def run(batches):
        for batch in batches:
            features = _feature_rows(batch.column("text"), lexicon)
            yield pa.RecordBatch.from_pydict(
                {"toxic": batch.column("toxic"), "part": batch.column("part"), "features": pa.array(features.tolist(), pa.list_(pa.float64()))}
            )

    return run


def learn(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS, lexicon_size: int = LEXICON
) -> ToxicityModel:
    """A model from `labels` (`doc_id`, `toxic`) of `docs`; `sample_rows` bounds the rows of each class it looks at."""
    known = (
        labels.filter("doc_id is not null and toxic in (0, 1)")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("draw", F.xxhash64(F.lit(33), "doc_id"))
    )
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    picked = [known.filter(F.col("toxic") == c).orderBy("draw", "doc_id").limit(sample_rows) for c in (0, 1)]
    chosen = picked[0].union(picked[1]).withColumn("part", F.pmod(F.xxhash64(F.lit(34), "doc_id"), F.lit(100)).cast("int"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # At most two times sample_rows ids are broadcast.
    sample = texts.join(F.broadcast(chosen.drop("draw")), "doc_id").select("toxic", "part", "text")
    sample = materialize(spark, sample.repartition(F.expr("part")), "toxicity-sample")
    lexicon = _learn_lexicon(sample, lexicon_size)
    rows = (
        sample.filter("part >= 50")
        .mapInArrow(_with_features(lexicon), "toxic int, part int, features array<double>")
        .toPandas()
    )
    toxic, part = rows["toxic"].to_numpy(dtype=np.float64), rows["part"].to_numpy()
    growing, fitting = part < 85, part >= 85
    if len(np.unique(toxic[growing])) < 2:
        return ToxicityModel(lexicon, None, None)
    features = np.array(rows["features"].tolist())
    left_out = {c: max(sizes.get(c, 0) / sample_rows, 1.0) for c in (0, 1)}
    weights = np.where(toxic > 0, left_out[1], left_out[0])
    weights = weights / weights.mean()
    trees = BoostedTrees().fit(features[growing], toxic[growing], weights[growing])
    calibration = None
    if len(np.unique(toxic[fitting])) == 2:
        calibration = Isotonic().fit(trees.margins(features[fitting]), toxic[fitting], weights[fitting])
    return ToxicityModel(lexicon, trees, calibration)


def score_texts(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """`docs` (`text`, others) with `score` and `predicted`."""
    docs = docs.drop("score", "predicted").withColumn("text", F.col("text").cast("string"))

    def score(batches):
        for batch in batches:
            scores = model.scores(batch.column("text"))
            predicted = (scores >= 0.5).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores), pa.array(predicted)], names=[*batch.schema.names, "score", "predicted"]
            )

    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, *added]))


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Whether the crc32 of the id as text (null: empty) is a multiple of `folds`."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % F.lit(folds) == 0
