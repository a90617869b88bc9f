"""Token ids in binary shards with a minimal perfect hash index (operator 5).

Documents are dealt out by ranges of their key and encoded in ascending order. Each task
writes shards of about SHARD_IDS ids; a shard is one row of a Parquet folder, so any
store that Spark can write to will hold it:

    part, seq       place of the shard in the global order
    keys            the documents' keys, in order
    bounds          where each document's ids begin, and the end (unsigned 64-bit)
    ids             the raw id payload, 16 or 32 bits an id, little-endian
    seed, levels    the minimal perfect hash function of the shard's distinct keys
    marks           fingerprint of the key in each slot (unsigned 32-bit)
    places, repeats first document with the slot's key, and how many have it

The hash function puts keys into bit arrays, level by level: a key that is alone at its
bit stays there, the others go to the next level; the slot of a key is the number of
bits set before its own. A lookup costs a constant number of probes and rejects foreign
keys by the fingerprint.

Encoding splits texts at plain spaces and line ends, across which the vocabulary never
joins anything, and encodes each distinct piece once per task with the tokenizers
library, remembering a bounded number. Strings that the tokenizer has as tokens of its own are one id wherever they stand.

Defined cases: null and empty texts have the end id alone; null keys come first and are
one key; documents that share a key lie side by side, ordered by a hash of their text; an
empty table gives an empty folder. A document longer than a shard gets a shard of its own.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidegrid.llm.common import Powers, file_bytes, held, join_checked, mixed, new_folder, scan, slices, texts

END_ID = 1
SHARD_IDS = 4 << 20
MAX_BROADCAST_SHARDS = 1_000_000
LEVEL_LOAD = 2
# Pieces that a process remembers, and bytes of text encoded at a time.
KNOWN_BOUND = 4_000_000
SLICE = 4 << 20


class PieceEncoder:
    """Ids of texts as raw bytes, with the end id.

    Pieces are found and hashed for a whole batch of texts at once; each distinct one is
    looked up in sorted arrays of known hashes, and its ids are gathered. Two pieces are
    taken for one if their 64-bit hashes agree.
    """

    def __init__(self, file: bytes, end_id: int = END_ID) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_buffer(file)
        # strings that the tokenizer takes out of a text as they are, before anything else
        self.taken = {t.content.encode(): i for i, t in self.model.get_added_tokens_decoder().items()}
        longest = sorted(self.taken, key=len, reverse=True)
        self.split = re.compile(b"(" + b"|".join(map(re.escape, longest)) + b")") if longest else None
        vocabulary = self.model.get_vocab()
        self.dtype = np.dtype("<u2" if len(vocabulary) <= 1 << 16 else "<u4")
        self.end = np.array([end_id], self.dtype).tobytes()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.powers = Powers()
        self.forget()

    def forget(self) -> None:
        self.known, self.first, self.count = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, self.dtype)

    def learn(self, pieces: list[str]) -> dict[str, np.ndarray]:
        """Ids of new pieces.

        Pieces of letters are one word each, so they are encoded side by side, a space
        between them, and told apart by the ids that end a word. If the numbers do not
        agree (a letter's lower case may hold a mark), and for other pieces, the library
        says which piece an id comes from.
        """
        out: dict[str, np.ndarray] = {}
        words = [p for p in pieces if p.isalpha()]
        for at in range(0, len(words), 1000):
            part = words[at : at + 1000]
            ids = np.array(self.model.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, self.dtype)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(part):
                self.cut(ids, np.concatenate([[0], ends]), part, out)
        rest = [p for p in pieces if p not in out]
        if rest:
            made = self.model.encode(rest, is_pretokenized=True, add_special_tokens=False)
            edges = np.searchsorted(np.array(made.word_ids, np.int64), np.arange(len(rest) + 1))
            self.cut(np.array(made.ids, self.dtype), edges, rest, out)
        return out

    def cut(self, ids: np.ndarray, edges: np.ndarray, pieces: list[str], out: dict[str, np.ndarray]) -> None:
        for piece, a, b in zip(pieces, edges.tolist(), edges[1:].tolist()):
            out[piece] = ids[a:b]

    def remember(self, hashes: np.ndarray, pieces: list[str]) -> None:
        """Add new pieces, whose hashes are sorted, to the arrays."""
        learnt = self.learn(list(dict.fromkeys(pieces)))
        ids = [learnt[p] for p in pieces]
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.first = np.insert(self.first, at, len(self.ids) + np.cumsum(count) - count)
        self.count = np.insert(self.count, at, count)
        self.ids = np.concatenate([self.ids, *ids])

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where sorted hashes stand in the arrays, and which are there."""
        at = np.minimum(np.searchsorted(self.known, hashes), max(0, len(self.known) - 1))
        return at, self.known[at] == hashes if len(self.known) else np.zeros(len(hashes), bool)

    def encode(self, batch: list[bytes]) -> list[bytes]:
        """Raw ids of each text, with the end id."""
        raw = self.plain(batch)
        for k, text in enumerate(batch):
            if self.split and self.split.search(text):
                parts = self.split.split(text)
                between = self.plain(parts[::2])
                taken = [np.array([self.taken[p]], self.dtype).tobytes() for p in parts[1::2]] + [b""]
                raw[k] = b"".join(x for pair in zip(between, taken) for x in pair)
        return [ids + self.end for ids in raw]

    def plain(self, batch: list[bytes]) -> list[bytes]:
        """Raw ids of texts in which no string is taken out."""
        blob = b"\n".join(batch)
        data = np.frombuffer(blob, np.uint8)
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = (data != ord(" ")) & (data != ord("\n"))
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = turns[::2], turns[1::2]
        hashes = self.powers.between(self.powers.sums(data), start, end)
        distinct, seen, which = np.unique(hashes, return_index=True, return_inverse=True)
        _, there = self.places(distinct)
        if not there.all():
            new = seen[~there].tolist()
            if len(self.known) + len(new) > KNOWN_BOUND:
                self.forget()
                new, there = seen.tolist(), np.zeros(len(distinct), bool)
            self.remember(distinct[~there], [blob[start[k] : end[k]].decode() for k in new])
        at = self.places(distinct)[0][which]
        count = self.count[at]
        stop = np.cumsum(count)
        ids = self.ids[np.repeat(self.first[at] - stop + count, count) + np.arange(stop[-1] if len(stop) else 0)]
        # a text's pieces begin before the line end that follows it
        edges = np.cumsum([0] + [len(t) + 1 for t in batch])
        edges = np.concatenate([[0], stop])[np.searchsorted(start, edges)] * self.dtype.itemsize
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip(edges.tolist(), edges[1:].tolist())]


def key_bytes(key) -> bytes:
    return b"" if key is None else b"=" + str(key).encode()


def key_hashes(keys: list[bytes], seed: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k, seed) for k in keys), np.uint64, len(keys))


def level_bits(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mixed(hashes + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))) % np.uint64(size)).astype(np.int64)


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes ^ np.uint64(0xD1B54A32D192ED03)) >> np.uint64(32)).astype("<u4")


class PerfectHash:
    """A minimal perfect hash function over distinct keys."""

    def __init__(self, seed: int, levels: list[bytes]) -> None:
        self.seed, self.levels = seed, levels
        self.bits = [np.unpackbits(np.frombuffer(x, np.uint8), bitorder="little") for x in levels]
        counts = np.cumsum([0] + [int(b.sum()) for b in self.bits])
        self.ranks = [np.cumsum(b, dtype=np.int64) - b + n for b, n in zip(self.bits, counts)]

    @classmethod
    def build(cls, keys: list[bytes]) -> PerfectHash:
        seed = 0
        while len(np.unique(rest := key_hashes(keys, seed))) < len(keys):
            seed += 1
        levels = []
        while len(rest):
            size = -(-LEVEL_LOAD * len(rest) // 8) * 8
            at = level_bits(rest, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").tobytes())
            rest = rest[~alone[at]]
        return cls(seed, levels)

    def slots(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each key (-1: surely foreign) and its fingerprint."""
        hashes = key_hashes(keys, self.seed)
        out = np.full(len(keys), -1, np.int64)
        for level, (bits, ranks) in enumerate(zip(self.bits, self.ranks)):
            at = level_bits(hashes, level, len(bits))
            hit = (out < 0) & (bits[at] == 1)
            out[hit] = ranks[at[hit]]
        return out, fingerprints(hashes)


def shard_row(part: int, seq: int, keys: list, payloads: list[bytes], width: int) -> dict:
    named = [key_bytes(k) for k in keys]
    first: dict[bytes, int] = {}
    repeats: dict[bytes, int] = {}
    for place, name in enumerate(named):
        first.setdefault(name, place)
        repeats[name] = repeats.get(name, 0) + 1
    distinct = list(first)
    function = PerfectHash.build(distinct)
    slot, mark = function.slots(distinct)
    marks, places, times = (np.zeros(len(distinct), "<u4") for _ in range(3))
    marks[slot], places[slot], times[slot] = mark, [first[k] for k in distinct], [repeats[k] for k in distinct]
    bounds = np.concatenate([[0], np.cumsum([len(p) // width for p in payloads])]).astype("<u8")
    return {
        "part": part,
        "seq": seq,
        "n_ids": int(bounds[-1]),
        "width": width,
        "keys": keys,
        "bounds": bounds.tobytes(),
        "ids": b"".join(payloads),
        "seed": function.seed,
        "levels": function.levels,
        "marks": marks.tobytes(),
        "places": places.tobytes(),
        "repeats": times.tobytes(),
    }


def shard_types(key_type) -> tuple[pa.Schema, str]:
    fields = [("part", pa.int32()), ("seq", pa.int32()), ("n_ids", pa.int64()), ("width", pa.int32()), ("keys", pa.list_(to_arrow_type(key_type)))]
    fields += [("bounds", pa.binary()), ("ids", pa.binary()), ("seed", pa.int64()), ("levels", pa.list_(pa.binary()))]
    fields += [(c, pa.binary()) for c in ("marks", "places", "repeats")]
    schema = f"part int, seq int, n_ids long, width int, keys array<{key_type.simpleString()}>, bounds binary, ids binary, "
    return pa.schema(fields), schema + "seed long, levels array<binary>, marks binary, places binary, repeats binary"


def write_shards(docs: DataFrame, folder: str, key: str, text: str, model: str, shard_ids: int = SHARD_IDS) -> None:
    """Encode all documents and write the shards."""
    key_type = docs.schema[key].dataType
    shipped = docs.sparkSession.sparkContext.broadcast(file_bytes(model))
    arrow, schema = shard_types(key_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = shipped.value
        encoder = held(("pieces", zlib.crc32(file), len(file)), lambda: PieceEncoder(file))
        part, seq = TaskContext.get().partitionId(), 0
        keys, payloads, size = [], [], 0
        for batch in batches:
            for piece in slices(batch, SLICE):
                for name, ids in zip(piece.column(0).to_pylist(), encoder.encode(texts(piece.column(1)))):
                    if size and size + len(ids) > shard_ids * encoder.dtype.itemsize:
                        yield pa.RecordBatch.from_pylist([shard_row(part, seq, keys, payloads, encoder.dtype.itemsize)], schema=arrow)
                        keys, payloads, size, seq = [], [], 0, seq + 1
                    keys.append(name)
                    payloads.append(ids)
                    size += len(ids)
        if keys:
            yield pa.RecordBatch.from_pylist([shard_row(part, seq, keys, payloads, encoder.dtype.itemsize)], schema=arrow)

    tie = F.xxhash64(F.col(text).cast("string"))
    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"), tie.alias("_tie"))
    # a key that many documents share is spread over ranges by the hash of their texts
    ordered = rows.repartitionByRange("_key", "_tie").sortWithinPartitions("_key", "_tie").select("_key", "_text")
    ordered.mapInArrow(run, schema).write.parquet(folder)


class Shard:
    """One shard in memory."""

    def __init__(self, row: dict) -> None:
        self.function = PerfectHash(row["seed"], row["levels"])
        self.marks, self.places, self.repeats = (np.frombuffer(row[c], "<u4") for c in ("marks", "places", "repeats"))
        self.bounds = np.frombuffer(row["bounds"], "<u8").astype(np.int64)
        self.ids = np.frombuffer(row["ids"], f"<u{row['width']}")

    def find(self, keys: list) -> tuple[np.ndarray, np.ndarray]:
        """First document and number of documents of each key; 0 documents if absent."""
        slot, mark = self.function.slots([key_bytes(k) for k in keys])
        if not len(self.marks):
            return slot, np.zeros(len(slot), np.int64)
        there = (slot >= 0) & (self.marks[slot] == mark)
        return np.where(there, self.places[slot], 0), np.where(there, self.repeats[slot], 0)

    def document(self, place: int) -> np.ndarray:
        return self.ids[self.bounds[place] : self.bounds[place + 1]]


def shards(spark: SparkSession, folder: str, key_type) -> DataFrame:
    """The shards with base: the number of ids in all shards before."""
    rows = spark.read.schema(shard_types(key_type)[1]).parquet(folder)
    # one narrow row per shard; a shard holds millions of ids
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.select("part", "seq", "n_ids").select("part", "seq", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("base"))
    return join_checked(rows, bases, ["part", "seq"], "inner", MAX_BROADCAST_SHARDS)


def read_documents(spark: SparkSession, folder: str, key: str, key_type) -> DataFrame:
    """key, start, n_tokens, ids_crc32 of every document, each found through the index."""
    arrow = pa.schema([(key, to_arrow_type(key_type)), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard, keys, out = Shard(row), row["keys"], []
                first, times = shard.find(keys)
                for k, (name, a, n) in enumerate(zip(keys, first.tolist(), times.tolist())):
                    if not a <= k < a + n:
                        raise ValueError(f"index and shard disagree on key {name}")
                    ids = shard.document(k)
                    out.append((row["base"] + int(shard.bounds[k]), len(ids), zlib.crc32(ids.astype("<u4"))))
                yield pa.RecordBatch.from_arrays([pa.array(keys, arrow.types[0]), *(pa.array(c, pa.int64()) for c in zip(*out))], schema=arrow)

    rows = shards(spark, folder, key_type)
    return rows.mapInArrow(run, f"`{key}` {key_type.simpleString()}, start long, n_tokens long, ids_crc32 long")


def read_keys(spark: SparkSession, folder: str, wanted: DataFrame, key: str, key_type) -> DataFrame:
    """key, ids of the wanted keys: each key goes to the shards whose range holds it."""
    rows = spark.read.schema(shard_types(key_type)[1]).parquet(folder)
    ranges = rows.select("part", "seq", F.array_min("keys").alias("_low"), F.array_max("keys").alias("_high"))
    asked = wanted.select(F.col(key).alias("_key")).where("_key IS NOT NULL").distinct()
    placed = asked.join(F.broadcast(ranges) if ranges.count() <= MAX_BROADCAST_SHARDS else ranges, F.col("_key").between(F.col("_low"), F.col("_high")))
    lists = placed.groupBy("part", "seq").agg(F.collect_list("_key").alias("wanted"))
    arrow = pa.schema([(key, to_arrow_type(key_type)), ("ids", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                first, times = shard.find(row["wanted"])
                found = [(k, shard.document(a + j).tolist()) for k, a, n in zip(row["wanted"], first.tolist(), times.tolist()) for j in range(n)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), arrow.types)], schema=arrow)

    return rows.join(lists, ["part", "seq"]).mapInArrow(run, f"`{key}` {key_type.simpleString()}, ids array<long>")


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan(spark, sf_dir, "documents")
    folder = new_folder(spark, "token-shards")
    write_shards(docs, folder, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"))
    return read_documents(spark, folder, "doc_id", docs.schema["doc_id"].dataType)
