"""Quality classifier (operator 2): a factorisation machine over hashed features.

Features of a text: its distinct lower-cased words, hashed into WORD_SLOTS slots and
scaled to unit length; steps of structure statistics; and the recorded length as
metadata. Language, source, key and labels are never features. The score of a text is
w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j; the pairwise term is half of the square
of the sum minus the sum of the squares, so it costs as much as the linear one.

The machine is fitted on at most TRAIN_ROWS labelled rows (those of lowest key hash)
whose crc32(key as text) mod 3 is not 1; that remainder is held out. Features of these
rows are made in parallel; one task fits the model, whose size is fixed.

Defined cases: null and empty texts have no words and are scored by their structure;
a null key is not held out; labels of one document given twice count once, as bad if any
is bad; null labels are ignored; without labelled rows every score is 0.5. Of rows that
repeat a labelled key one is learned from; all are scored one by one. Columns other than key, text and length are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidegrid.llm.common import WordHashes, join_checked, map_rows, mixed, scan, texts
from tidegrid.llm.structure import DIGIT, SIGN, SYMBOL, UPPER, measure

TRAIN_ROWS = 12_000
WORD_SLOTS = 1 << 15
STEPS = 24
RANK = 8
EPOCHS = 6
BATCH = 128
SEED = 20261
SCORED_AT_ONCE = 500


def structure(c, length: int | None) -> list[int]:
    """A step from 0 to STEPS - 1 for each statistic."""
    chars, words = max(1, c.word_chars), max(1, c.n_words)
    shares = [
        c.kinds[SYMBOL] / chars,
        c.kinds[UPPER] / chars,
        c.kinds[DIGIT] / chars,
        c.kinds[SIGN] / chars,
        c.n_dup_lines / max(1, c.n_lines),
        c.n_repeat_words / words,
        1 - len(set(c.words)) / words,
        sum(1 for w in c.words if len(w) == 1) / words,
    ]
    sizes = [c.n_words, c.n_lines, c.word_chars, length or 0, 8 * (c.word_chars / words) ** 2]
    steps = [int(np.sqrt(v) * (STEPS - 1)) for v in shares]
    steps += [int(1.4 * np.log2(1 + v)) for v in sizes]
    return [min(STEPS - 1, s) for s in steps]


N_STATS = 13
SLOTS = WORD_SLOTS + N_STATS * STEPS


def features(text: bytes, length: int | None, memory: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of one text."""
    counts = measure(text, memory)
    lowered = np.unique(memory.of(list(set(text.lower().split()))))
    words = (mixed(lowered) % np.uint64(WORD_SLOTS)).astype(np.int32)
    steps = WORD_SLOTS + np.arange(N_STATS) * STEPS + np.array(structure(counts, length))
    slots = np.concatenate([words, steps.astype(np.int32)])
    values = np.full(len(slots), 1.0, np.float32)
    values[: len(words)] = 1 / np.sqrt(max(1, len(words)))
    return slots, values


class Machine:
    """Weights of all slots; `score` and `fit` take rows laid end to end."""

    def __init__(self, bias: float, linear: np.ndarray, factors: np.ndarray) -> None:
        self.bias, self.linear, self.factors = bias, linear, factors

    @classmethod
    def fresh(cls) -> Machine:
        rng = np.random.default_rng(SEED)
        return cls(0.0, np.zeros(SLOTS, np.float32), rng.normal(0, 0.02, (SLOTS, RANK)).astype(np.float32))

    def to_bytes(self) -> bytes:
        return b"".join(a.astype("<f4").tobytes() for a in (np.array([self.bias]), self.linear, self.factors))

    @classmethod
    def from_bytes(cls, data: bytes) -> Machine:
        a = np.frombuffer(data, "<f4")
        return cls(float(a[0]), a[1 : SLOTS + 1], a[SLOTS + 1 :].reshape(SLOTS, RANK))

    def sums(self, slots, values, starts):
        x = values[:, None] * self.factors[slots]
        total, squares = np.add.reduceat(x, starts), np.add.reduceat(x * x, starts)
        line = np.add.reduceat(values * self.linear[slots], starts)
        raw = self.bias + line + 0.5 * (total * total - squares).sum(1)
        return raw, total, x

    def score(self, slots, values, starts) -> np.ndarray:
        raw = self.sums(slots, values, starts)[0].astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], marks: np.ndarray) -> Machine:
        """Adaptive gradient steps on the logistic loss, in a fixed order of batches."""
        rng = np.random.default_rng(SEED)
        seen_linear, seen_factors, seen_bias = np.full(SLOTS, 1e-4), np.full((SLOTS, RANK), 1e-4), 1e-4
        for epoch in range(EPOCHS):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), BATCH):
                part = order[at : at + BATCH]
                slots, values, starts = end_to_end([rows[i] for i in part])
                size = np.diff(np.append(starts, len(slots)))
                raw, total, x = self.sums(slots, values, starts)
                pull = (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - marks[part]) / len(part)
                each = np.repeat(pull, size)
                used, where = np.unique(slots, return_inverse=True)
                g_linear = np.bincount(where, each * values, len(used)) + 1e-6 * self.linear[used]
                g_factors = 1e-6 * self.factors[used]
                push = (each * values)[:, None] * (np.repeat(total, size, 0) - x)
                for f in range(RANK):
                    g_factors[:, f] += np.bincount(where, push[:, f], len(used))
                seen_linear[used] += g_linear**2
                seen_factors[used] += g_factors**2
                seen_bias += pull.sum() ** 2
                self.linear[used] -= 0.1 * g_linear / np.sqrt(seen_linear[used])
                self.factors[used] -= 0.03 * g_factors / np.sqrt(seen_factors[used])
                self.bias -= 0.1 * pull.sum() / np.sqrt(seen_bias)
        return self


def end_to_end(rows):
    sizes = np.array([len(s) for s, _ in rows])
    return np.concatenate([s for s, _ in rows]), np.concatenate([v for _, v in rows]), np.cumsum(sizes) - sizes


def held_out(key) -> F.Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str, length: str, train_rows: int = TRAIN_ROWS) -> bytes:
    marks = labels.where(F.col("quality").isNotNull() & F.col(key).isNotNull() & ~held_out(key))
    marks = marks.groupBy(F.col(key).alias("_key")).agg(F.min("quality").alias("_mark"))
    marks = marks.orderBy(F.xxhash64("_key"), "_key").limit(train_rows)
    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"), F.col(length).cast("long").alias("_length"))
    rows = join_checked(rows, marks, ["_key"], "inner", train_rows)

    def make():
        memory = WordHashes()

        def work(columns):
            keys, column, lengths, given = columns
            made = [features(t, n, memory) for t, n in zip(texts(column), lengths.to_pylist())]
            return [keys.cast(pa.string()), [s.astype("<i4").tobytes() for s, _ in made], [v.astype("<f4").tobytes() for _, v in made], given.cast(pa.int32())]

        return work

    arrow = pa.schema([("_key", pa.string()), ("slots", pa.binary()), ("vals", pa.binary()), ("mark", pa.int32())])
    # of rows that share a labelled key, the one of least text and length is learned from,
    # so that no more than train_rows rows reach the fitting task
    first = F.min(F.struct("_text", "_length")).alias("_first")
    rows = rows.groupBy("_key", "_mark").agg(first).select("_key", "_first._text", "_first._length", "_mark")
    made = map_rows(rows, make, "_key string, slots binary, vals binary, mark int", arrow)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = [r for b in batches for r in b.to_pylist()]
        given.sort(key=lambda r: (r["_key"], r["slots"]))
        machine = Machine.fresh()
        if given:
            inputs = [(np.frombuffer(r["slots"], "<i4"), np.frombuffer(r["vals"], "<f4")) for r in given]
            machine.fit(inputs, np.array([r["mark"] for r in given], np.float32))
            model = machine.to_bytes()
        else:
            model = Machine(0.0, machine.linear, np.zeros_like(machine.factors)).to_bytes()
        yield pa.RecordBatch.from_pydict({"model": [model]})

    # a shuffle before the one fitting task: scan, join and features stay parallel
    return bytes(made.repartition(1).mapInArrow(learn, "model binary").first()["model"])


def score(docs: DataFrame, model: bytes, key: str, text: str, length: str) -> DataFrame:
    """key and score of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        memory, machine = WordHashes(), Machine.from_bytes(shipped.value)

        def work(columns):
            keys, column, lengths = columns
            made = [features(t, n, memory) for t, n in zip(texts(column), lengths.to_pylist())]
            return [keys, machine.score(*end_to_end(made)) if made else []]

        return work

    dtype = docs.schema[key].dataType
    arrow = pa.schema([(key, to_arrow_type(dtype)), ("score", pa.float64())])
    rows = docs.select(F.col(key), F.col(text).cast("string"), F.col(length).cast("long"))
    return map_rows(rows, make, f"`{key}` {dtype.simpleString()}, score double", arrow)


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", length: str = "n_chars") -> DataFrame:
    """key, held_out, score, predicted."""
    rows = score(docs, fit(docs, labels, key, text, length), key, text, length)
    return rows.select(key, held_out(key).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", length: str = "n_chars") -> DataFrame:
    """The rows that the classifier accepts, with all their columns."""
    model = fit(docs, labels, key, text, length)
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    holder = {}

    @F.arrow_udf("boolean")
    def good(column: pa.Array, lengths: pa.Array) -> pa.Array:
        if not holder:
            holder["use"] = WordHashes(), Machine.from_bytes(shipped.value)
        memory, machine = holder["use"]
        good_rows: list[bool] = []
        # a few texts at a time, since scoring widens each feature to RANK numbers
        for at in range(0, len(column), SCORED_AT_ONCE):
            part = zip(texts(column.slice(at, SCORED_AT_ONCE)), lengths.slice(at, SCORED_AT_ONCE).to_pylist())
            made = [features(t, n, memory) for t, n in part]
            good_rows += (machine.score(*end_to_end(made)) >= 0.5).tolist()
        return pa.array(good_rows, pa.bool_())

    return docs.where(good(F.col(text).cast("string"), F.col(length).cast("long")))


def op2_fm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(scan(spark, sf_dir, "documents"), scan(spark, sf_dir, "labels"))
