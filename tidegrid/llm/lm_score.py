"""Language model scoring by cross-entropy difference (operator 4).

Two bigram models, of target texts and of all texts (the background), share vocabulary,
bigram inventory and smoothing, and the background's counts are scaled to the target's
number of words, so both are smoothed alike. A text's score is the mean over its words
of the loss under the target model minus the loss under the background model: the lower,
the more it resembles the target.

Every word and every bigram counts, at any size; nothing that grows with the corpus is
broadcast or reaches the driver. Texts are written in blocks of some megabytes. A block
sends its distinct words, first words of bigrams and bigrams, with their counts in the
block, to the buckets of their hashes; a bucket adds them up and answers each block that
asked; and each block's texts are scored with the answers. With c the counts,
p(w | h) = (c(h, w) + M p(w)) / (c(h) + M), and p(w) = (c(w) + 1) / (n + v + 1) for v
distinct words, the last 1 being for all unknown words; both sum to 1.

Defined cases: null and empty texts have no words and score 0; without any target text
the target model is uniform; a document is a target if any target row has its key; null
keys are never targets; repeated rows count and are scored one by one; an empty table
gives an empty result. Words are told apart by 64-bit hashes. Columns other than key and
text are never read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidegrid.llm.common import WordHashes, join_checked, mixed, scan, slices, texts, written

BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20  # of text, for each bucket
M = 64.0
MAX_BROADCAST_TARGETS = 1_000_000
START, UNKNOWN = 0, 1
BEGIN = np.uint64(0x5851F42D4C957F2D)  # stands before the first word of a text
ODD = np.uint64(0x9E3779B97F4A7C15)
KINDS = ("words", "firsts", "pairs")
PIECES = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), *((f"{k}{c}", pa.binary()) for k in KINDS for c in ("", "_n"))])
PIECES_SQL = "bucket long, block long, " + ", ".join(f"{k} binary, {k}_n binary" for k in KINDS)
# Answers have a block; a bucket's own totals have none.
ANSWERS = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), *((f"{k}_n", pa.binary()) for k in KINDS), *((c, pa.int64()) for c in ("distinct", "background", "target"))])
ANSWERS_SQL = "block long, bucket long, " + ", ".join(f"{k}_n binary" for k in KINDS) + ", distinct long, background long, target long"


def packed(a: np.ndarray) -> bytes:
    """64-bit numbers by byte planes, without the highest ones if they are all zero.

    Small or sorted numbers compress well so.
    """
    planes = np.ascontiguousarray(np.ascontiguousarray(a).reshape(-1).view(np.uint8).reshape(-1, 8).T)
    kept = next((k for k in range(8, 0, -1) if planes[k - 1].any()), 1)
    return bytes([kept]) + planes[:kept].tobytes()


def unpacked(data: bytes, dtype: type) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : data[0]] = planes.T
    return out.reshape(-1).view(dtype)


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, a place of each in x, and each element's place among them."""
    order = np.argsort(x)
    ordered = x[order]
    new = np.ones(len(x), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    where = np.empty(len(x), np.int64)
    where[order] = np.cumsum(new) - 1
    return ordered[new], order[new], where


class Items:
    """Words, first words and bigrams of a block's texts: `distinct` of each kind."""

    def __init__(self, column: pa.Array, memory: WordHashes) -> None:
        words = [memory.of(t.lower().split()) for t in texts(column)]
        self.sizes = np.array([len(x) for x in words], np.int64)
        after = np.concatenate([np.empty(0, np.uint64), *words])
        before = np.concatenate([np.full(1, BEGIN), after[:-1]])[: len(after)]
        before[(np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]] = BEGIN
        self.found = {"words": distinct(after), "firsts": distinct(before), "pairs": distinct(mixed(mixed(before) * ODD + after))}

    def counts(self, kind: str, targets: np.ndarray) -> np.ndarray:
        """[2, items] counts in all rows and in target rows."""
        values, _, where = self.found[kind]
        wanted = np.repeat(targets, self.sizes)
        return np.stack([np.bincount(w, minlength=len(values)) for w in (where, where[wanted])])


def blocks(docs: DataFrame, key: str, text: str, targets: DataFrame | None = None) -> DataFrame:
    """Rows in written blocks: block (a random number), size in bytes, body (see `opened`)."""
    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").cast("binary").alias("_text"))
    if targets is None:
        rows = rows.withColumn("_target", F.lit(False))
    else:
        marks = targets.select(F.col(key).alias("_key")).where("_key IS NOT NULL").distinct().withColumn("_target", F.lit(True))
        rows = join_checked(rows, marks, ["_key"], "left", MAX_BROADCAST_TARGETS)
        rows = rows.select("_key", "_text", F.coalesce("_target", F.lit(False)).alias("_target"))
    dtype = docs.schema[key].dataType
    inner = pa.schema([("keys", to_arrow_type(dtype)), ("texts", pa.binary()), ("marks", pa.bool_())])
    arrow = pa.schema([("block", pa.int64()), ("size", pa.int64()), ("body", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, BLOCK_BYTES):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, inner, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(part.columns, inner.types)], schema=inner))
                name = int.from_bytes(os.urandom(8), "little", signed=True)
                yield pa.RecordBatch.from_pydict({"block": [name], "size": [part.nbytes], "body": [sink.getvalue().to_pybytes()]}, schema=arrow)

    return written(rows.mapInArrow(pack, "block long, size long, body binary"), "lm-blocks")


def opened(body: pa.Scalar) -> pa.RecordBatch:
    """keys, texts, marks of a block."""
    return pa.ipc.open_stream(body.as_buffer()).read_next_batch()


def pieces(blocks: DataFrame, bits: int, counted: bool) -> DataFrame:
    """What blocks send to the 2^bits buckets; not counted: they only ask."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.empty(0, np.uint64)
        for batch in batches:
            for i, block in enumerate(batch["block"].to_pylist()):
                rows = opened(batch["body"][i])
                items = Items(rows["texts"], memory)
                targets = rows["marks"].to_numpy(zero_copy_only=False)
                out = {"bucket": range(1 << bits), "block": [block] * (1 << bits)}
                for kind in KINDS:
                    values, n = items.found[kind][0], items.counts(kind, targets) * int(counted)
                    cuts = [0, *np.searchsorted(values, edges).tolist(), len(values)]
                    out[kind] = [packed(values[a:b]) for a, b in zip(cuts, cuts[1:])]
                    out[f"{kind}_n"] = [packed(n[:, a:b]) for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_pydict(out, schema=PIECES)

    return blocks.select("block", "body").mapInArrow(send, PIECES_SQL)


def added_up(table: pa.Table) -> pa.Table:
    """A bucket's answers to all its blocks, and its totals."""
    names = table["block"].to_pylist()
    out = {"block": [*names, None], "bucket": [*table["bucket"].to_pylist(), None]}
    for kind in KINDS:
        asked = [unpacked(x, np.uint64) for x in table[kind].to_pylist()]
        ends = np.cumsum([0, *map(len, asked)]).tolist()
        values, _, where = distinct(np.concatenate(asked))
        del asked
        n = np.concatenate([unpacked(x, np.int64).reshape(2, -1) for x in table[f"{kind}_n"].to_pylist()], 1)
        # sums of integers below 2^53 are exact
        sums = np.stack([np.bincount(where, c, len(values)) for c in n]).astype(np.int64)
        out[f"{kind}_n"] = [*(packed(sums[:, where[a:b]]) for a, b in zip(ends, ends[1:])), None]
        if kind == "words":
            totals = [(sums[0] > 0).sum(), *sums.sum(1)]
    for name, total in zip(("distinct", "background", "target"), totals):
        out[name] = [*[None] * len(names), int(total)]
    return pa.Table.from_pydict(out, schema=ANSWERS)


@dataclass
class Losses:
    """Losses (negative logarithms) of the background (0) and the target (1)."""

    distinct: int
    background: int
    target: int

    @property
    def scale(self) -> np.ndarray:
        return np.array([[self.target / self.background if self.background and self.target else 1.0], [1.0]])

    def shares(self, words: np.ndarray) -> np.ndarray:
        return (words * self.scale + 1) / (np.array([[self.background], [self.target]]) * self.scale + self.distinct + 1)

    def leave(self, firsts: np.ndarray) -> np.ndarray:
        """Loss added to that of a word after these first words where the bigram does not occur."""
        return -np.log(M / (firsts * self.scale + M))

    def pairs(self, pairs: np.ndarray, firsts: np.ndarray, words: np.ndarray) -> np.ndarray:
        return -np.log((pairs * self.scale + M * self.shares(words)) / (firsts * self.scale + M))


def answers(asking: DataFrame, counted: DataFrame) -> tuple[DataFrame, Losses]:
    """What each block of `asking` gets to know of the counts in `counted`, and the totals."""
    bits = ((counted.agg(F.sum("size")).first()[0] or 0) // BUCKET_BYTES).bit_length()
    sent = pieces(counted, bits, True)
    if asking is not counted:
        sent = sent.unionByName(pieces(asking, bits, False))
    got = written(sent.groupBy("bucket").applyInArrow(added_up, ANSWERS_SQL), "lm-answers")
    totals = got.where("block IS NULL").agg(F.sum("distinct"), F.sum("background"), F.sum("target")).first()
    return got.where("block IS NOT NULL").drop("distinct", "background", "target"), Losses(*(int(x or 0) for x in totals))


def answered(items: Items, table: pa.Table) -> dict[str, np.ndarray]:
    """[2, items] of each kind: the answers of all buckets in the order of the block's items."""
    table = table.sort_by("bucket")
    empty = np.empty((2, 0), np.int64)
    return {k: np.concatenate([empty, *(unpacked(x, np.int64).reshape(2, -1) for x in table[f"{k}_n"].to_pylist())], 1) for k in KINDS}


def by_pair(items: Items, n: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The counts of a block's distinct bigrams, of their first words and of their words."""
    at = items.found["pairs"][1]
    return n["pairs"], n["firsts"][:, items.found["firsts"][2][at]], n["words"][:, items.found["words"][2][at]]


def score_blocks(asking: DataFrame, counted: DataFrame, key: str, dtype) -> DataFrame:
    got, losses = answers(asking, counted)
    reals = [(c, pa.float64()) for c in ("loss_target", "loss_background", "score")]
    arrow = pa.schema([(key, to_arrow_type(dtype)), ("n_words", pa.int64()), *reals])

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        made, memory = [], WordHashes()
        for body in left["body"]:
            rows = opened(body)
            items = Items(rows["texts"], memory)
            cost = losses.pairs(*by_pair(items, answered(items, right)))
            where, sizes = items.found["pairs"][2], items.sizes
            means = np.zeros((2, len(sizes)))
            some = sizes > 0
            if some.any():
                means[:, some] = np.add.reduceat(cost[:, where], (np.cumsum(sizes) - sizes)[some], axis=1) / sizes[some]
            made.append(pa.Table.from_arrays([rows["keys"], pa.array(sizes), *map(pa.array, (means[1], means[0], means[1] - means[0]))], schema=arrow))
        return pa.concat_tables(made) if made else arrow.empty_table()

    schema = f"`{key}` {dtype.simpleString()}, n_words long, loss_target double, loss_background double, score double"
    asked = asking.select("block", "body")
    return asked.groupBy("block").cogroup(got.groupBy("block")).applyInArrow(work, schema)


@dataclass
class Models:
    """Both models, as blocks of the texts they are made of.

    The arrays below gather everything on the driver: they are for looking at small
    models, and scoring does not use them.
    """

    counted: DataFrame

    @cached_property
    def gathered(self) -> tuple[pa.Table, Losses]:
        got, losses = answers(self.counted, self.counted)
        columns = ("first", "word", *(f"{k}_{side}" for k in ("pair", "first", "word") for side in range(2)))
        arrow = pa.schema([(c, pa.int64()) for c in columns])

        def work(left: pa.Table, right: pa.Table) -> pa.Table:
            made, memory = [], WordHashes()
            for body in left["body"]:
                items = Items(opened(body)["texts"], memory)
                at = items.found["pairs"][1]
                hashes = [items.found[k][0][items.found[k][2][at]].view(np.int64) for k in ("firsts", "words")]
                made.append(pa.Table.from_arrays([*map(pa.array, hashes), *(pa.array(c) for n in by_pair(items, answered(items, right)) for c in n)], schema=arrow))
            return pa.concat_tables(made) if made else arrow.empty_table()

        rows = self.counted.groupBy("block").cogroup(got.groupBy("block")).applyInArrow(work, ", ".join(f"{c} long" for c in columns))
        return rows.distinct().toArrow(), losses

    def column(self, name: str) -> np.ndarray:
        return self.gathered[0][name].to_numpy()

    def sides(self, kind: str) -> np.ndarray:
        return np.stack([self.column(f"{kind}_{side}") for side in range(2)])

    @cached_property
    def words(self) -> np.ndarray:
        """Hashes of the vocabulary; word i has the id i + 2."""
        return np.unique(self.column("word").view(np.uint64))

    def ids(self, name: str) -> np.ndarray:
        hashes = self.column(name).view(np.uint64)
        return np.where(hashes == BEGIN, START, np.searchsorted(self.words, hashes) + UNKNOWN + 1)

    def by_id(self, name: str) -> np.ndarray:
        """[2, v] counts of words or first words."""
        n = np.zeros((2, len(self.words) + 2))
        n[:, self.ids(name)] = self.sides(name)
        return n

    @property
    def single(self) -> np.ndarray:
        """[2, v] loss of a word; the start never follows a word."""
        loss = -np.log(self.gathered[1].shares(self.by_id("word")))
        loss[:, START] = 0
        return loss

    @property
    def leave(self) -> np.ndarray:
        return self.gathered[1].leave(self.by_id("first"))

    @property
    def pairs(self) -> np.ndarray:
        return np.sort(self.ids("first") * (len(self.words) + 2) + self.ids("word"))

    @property
    def losses(self) -> np.ndarray:
        """[2, pairs]"""
        order = np.argsort(self.ids("first") * (len(self.words) + 2) + self.ids("word"))
        return self.gathered[1].pairs(*(self.sides(k) for k in ("pair", "first", "word")))[:, order]


def fit(docs: DataFrame, targets: DataFrame, key: str, text: str) -> Models:
    return Models(blocks(docs, key, text, targets))


def score(docs: DataFrame, models: Models, key: str, text: str) -> DataFrame:
    """key, n_words, loss_target, loss_background (means per word), score: their difference."""
    return score_blocks(blocks(docs, key, text), models.counted, key, docs.schema[key].dataType)


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled good and not toxic."""
    docs, labels = scan(spark, sf_dir, "documents"), scan(spark, sf_dir, "labels")
    models = fit(docs, labels.where("quality = 1 AND toxic = 0"), "doc_id", "text")
    # the texts scored are those the models are made of, so their blocks serve for both
    return score_blocks(models.counted, models.counted, "doc_id", docs.schema["doc_id"].dataType)
