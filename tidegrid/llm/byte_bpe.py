"""Byte-level BPE (operator 10): vectorised pre-tokenisation, cached merges, decoding.

Text is cut where the public pattern cuts it, without a regex engine:

* every code point gets a class (plain space, other white space, letter, number,
  apostrophe, other) from one table;
* a four-state automaton says whether an apostrophe begins a token. The transition
  function of each code point is packed into one byte, functions are composed by a
  table, and an associative scan over blocks gives the state after every code point;
* token starts follow from classes, states and the two next code points.

The slices between starts go through a cache of merged ids, each with the byte at which
its piece begins in the slice, as the merging left it. Ids and offsets in the text are
little-endian unsigned 32-bit integers. Decoding places each id's piece at its offset and
refuses pieces that leave a gap or overlap; without offsets it puts them end to end.

Defined cases: a null or empty text has no ids and decodes to nothing; repeated rows
are encoded one by one; a slice longer than LONG bytes is merged with a heap, so one
very long word costs n log n. Columns other than the key and the text are never read.
"""

from __future__ import annotations

import base64
import heapq
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidegrid.llm.common import file_bytes, held, map_rows, scan, texts

SPACE, GAP, LETTER, NUMBER, QUOTE, OTHER = range(6)
# states after a code point: a plain space, a place where an apostrophe may begin a
# token, such an apostrophe, inside a run of other signs
AFTER_SPACE, OPEN, QUOTED, INSIDE = range(4)
LONG = 64
CACHE_BOUND = 200_000
# Bytes of text encoded at once: scratch arrays take some thirty times as much.
AT_ONCE = 1 << 20
BLOCK = 256


def class_table() -> np.ndarray:
    """The class of every code point, by the Unicode tables of the tokenizer library."""
    single = {bytes([i]): i for i in range(256)}
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((GAP, r"\s"), (LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        found = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        # a plane at a time, since the ids of its bytes are a list
        for plane in range(0, 0x110000, 1 << 16):
            points = "".join(chr(c) for c in range(plane, plane + (1 << 16)) if not 0xD800 <= c < 0xE000)
            members = found.decode_bytes(found.encode_ordinary(points)).decode()
            table[np.frombuffer(members.encode("utf-32-le"), np.uint32)] = kind
    table[ord(" ")], table[ord("'")] = SPACE, QUOTE
    return table


def packed(targets: list[int]) -> int:
    return sum(target << (2 * state) for state, target in enumerate(targets))


MOVES = np.array(
    [
        packed([AFTER_SPACE] * 4),
        packed([OPEN] * 4),
        packed([OPEN] * 4),
        packed([OPEN] * 4),
        packed([INSIDE, QUOTED, INSIDE, INSIDE]),
        packed([INSIDE] * 4),
    ],
    np.uint8,
)
IDENTITY = packed([0, 1, 2, 3])


def composition() -> np.ndarray:
    """after[g * 256 + f] is the function that applies f, then g."""
    g, f = np.meshgrid(np.arange(256), np.arange(256), indexing="ij")
    out = np.zeros((256, 256), np.uint8)
    for state in range(4):
        out |= (((g >> (2 * ((f >> (2 * state)) & 3))) & 3) << (2 * state)).astype(np.uint8)
    return out.ravel()


AFTER = composition()


def then(g: np.ndarray, f: np.ndarray) -> np.ndarray:
    return AFTER[(g.astype(np.uint16) << np.uint16(8)) | f]


def running(functions: np.ndarray) -> np.ndarray:
    """For each position, the composition of all functions up to it."""
    n = len(functions)
    if n <= BLOCK:
        out = functions.copy()
        step = 1
        while step < n:
            out[step:] = then(out[step:], out[:-step].copy())
            step *= 2
        return out
    blocks = -(-n // BLOCK)
    grid = np.full(blocks * BLOCK, IDENTITY, np.uint8)
    grid[:n] = functions
    grid = np.ascontiguousarray(grid.reshape(blocks, BLOCK).T)
    for k in range(1, BLOCK):
        grid[k] = then(grid[k], grid[k - 1])
    before = np.empty(blocks, np.uint8)
    before[0], before[1:] = IDENTITY, running(grid[-1])[:-1]
    return np.ascontiguousarray(then(grid, before[None, :]).T).ravel()[:n]


def token_starts(points: np.ndarray, first: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Where tokens begin in texts laid end to end; `first` holds their first positions."""
    n = len(points)
    kind = table[points]
    begins = np.zeros(n + 2, bool)
    begins[first], begins[n:] = True, True
    moves = MOVES[kind]
    # a text's first code point forgets what stands before it
    moves[first] = ((moves[first] >> np.uint8(2 * OPEN)) & np.uint8(3)) * np.uint8(0b01010101)
    state = running(moves) & np.uint8(3)

    gap = kind <= GAP
    group = np.where(gap, np.uint8(0), np.where(kind == QUOTE, np.uint8(OTHER), kind))
    starts = np.ones(n, bool)
    changed = group[1:] != group[:-1]
    ends_run = np.zeros(n, bool)
    ends_run[:-1] = gap[:-1] & ~gap[1:] & ~begins[1:n]
    # white space: a run begins a token, and so does its last sign before a word
    # words: attached to one plain space before them
    starts[1:] = np.where(gap[1:], ~gap[:-1] | ends_run[1:], np.where(gap[:-1], kind[:-1] != SPACE, changed))
    starts[first] = True

    at = np.flatnonzero(state == QUOTED)
    if len(at):
        ahead = np.concatenate([points, np.zeros(2, points.dtype)])
        one = np.where(begins[at + 1], 0, ahead[at + 1])
        two = np.where(begins[at + 1] | begins[at + 2], 0, ahead[at + 2])
        takes = np.isin(one, [ord(c) for c in "stmd"]).astype(np.int64)
        for pair in ("re", "ve", "ll"):
            takes[(one == ord(pair[0])) & (two == ord(pair[1]))] = 2
        at, takes = at[takes > 0], takes[takes > 0]
        starts[at + 1] = False
        after = at + 1 + takes
        starts[after[after < n]] = True
    return starts


class Merger(dict):
    """Slices of bytes to their ids, each followed by the byte its piece begins at, as
    unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: bytes) -> bytes:
        rank = self.ranks.get(piece)
        if rank is not None:
            pairs = rank.to_bytes(4, "little") + b"\0\0\0\0"
        else:
            merged = merge_short(piece, self.ranks) if len(piece) <= LONG else merge_long(piece, self.ranks)
            pairs = np.array(merged, "<u4").tobytes()
        if len(piece) <= LONG:
            if len(self) >= CACHE_BOUND:
                self.clear()
            self[piece] = pairs
        return pairs


def merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[tuple[int, int]]:
    """Join the pair of lowest rank, leftmost first, until no pair has a rank: ids and begins."""
    get, none = ranks.get, 1 << 60
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while pairs:
        best = min(pairs)
        if best == none:
            break
        i = pairs.index(best)
        parts[i] += parts[i + 1]
        del parts[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], none)
    begins = accumulate(map(len, parts), initial=0)
    return [(ranks[part], begin) for part, begin in zip(parts, begins)]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[tuple[int, int]]:
    """The same order of merges, with linked parts and a heap of candidate pairs."""
    n = len(piece)
    end = list(range(1, n + 1))  # end[i]: where the part that begins at i ends, 0 if none does
    left = list(range(-1, n))
    heap = []

    def offer(start: int) -> None:
        middle = end[start]
        if middle < n:
            rank = ranks.get(piece[start : end[middle]])
            if rank is not None:
                heapq.heappush(heap, (rank, start, middle, end[middle]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, start, middle, stop = heapq.heappop(heap)
        if end[start] != middle or end[middle] != stop:
            continue
        end[start], end[middle] = stop, 0
        if stop < n:
            left[stop] = start
        offer(start)
        if left[start] >= 0:
            offer(left[start])
    ids, start = [], 0
    while start < n:
        ids.append((ranks[piece[start : end[start]]], start))
        start = end[start]
    return ids


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class Encoder:
    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.merger = Merger(ranks)
        self.table = held(("bpe-classes",), class_table)

    def slices(self, batch: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        """The texts end to end, where slices and texts begin in bytes, and each text's range of slices."""
        blob = b"".join(batch)
        points = np.frombuffer(blob.decode().encode("utf-32-le"), np.uint32)
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        offset = np.concatenate([[0], np.cumsum(width)])
        size = np.array([len(t) for t in batch], np.int64)
        edge = np.concatenate([[0], np.cumsum(size)])
        if not len(points):
            return blob, np.empty(0, np.int64), edge, np.zeros(len(batch) + 1, np.int64)
        first = np.searchsorted(offset, edge[:-1][size > 0])
        starts = offset[:-1][token_starts(points, first, self.table)]
        return blob, starts, edge, np.searchsorted(starts, edge)

    def encode(self, batch: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        """Ids of each text, and the byte at which each id's piece begins."""
        blob, starts, edge, ranges = self.slices(batch)
        merged, bounds = self.merger, [*starts.tolist(), len(blob)]
        found = [merged[blob[a:b]] for a, b in zip(bounds, bounds[1:])] if len(starts) else []
        count = np.fromiter(map(len, found), np.int64, len(found)) >> 3
        pairs = np.frombuffer(b"".join(found), "<u4").reshape(-1, 2)
        # from the slice's beginning to the text's
        shift = starts - np.repeat(edge[:-1], np.diff(ranges))
        ids, begins = pairs[:, 0].tobytes(), (pairs[:, 1] + np.repeat(shift, count)).astype("<u4").tobytes()
        cuts = (4 * np.concatenate([[0], np.cumsum(count)])[ranges]).tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])], [begins[a:b] for a, b in zip(cuts, cuts[1:])]


class Decoder:
    """The pieces of all ids end to end, and where each lies."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            pieces[rank] = piece
        self.size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.first = np.cumsum(self.size) - self.size
        self.blob = np.frombuffer(b"".join(pieces), np.uint8)

    def decode(self, ids: list[bytes], begins: list[bytes] | None = None) -> list[bytes]:
        """The texts of ids, each piece at its place."""
        numbers = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
        size = self.size[numbers]
        stop = np.cumsum(size)
        count = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        edge = np.concatenate([[0], stop])[np.concatenate([[0], np.cumsum(count)])]
        if begins is not None:
            place = np.frombuffer(b"".join(begins), "<u4") + np.repeat(edge[:-1], count)
            if len(place) != len(stop) or (place + size != stop).any():
                raise ValueError("offsets leave a gap or overlap")
        total = int(edge[-1])
        text = self.blob[np.repeat(self.first[numbers] - stop + size, size) + np.arange(total)].tobytes()
        return [text[a:b] for a, b in zip(edge.tolist(), edge[1:].tolist())]


def encode_documents(docs: DataFrame, key: str, text: str, ranks_file: str, offsets: bool = True) -> DataFrame:
    """key, n_tokens, token_ids (unsigned 32-bit, little-endian) and, if asked for,
    token_offsets: the byte at which each id's piece begins, in the same format."""
    shipped = docs.sparkSession.sparkContext.broadcast(file_bytes(ranks_file))

    def make():
        encoder = Encoder(read_ranks(shipped.value))

        def work(columns):
            keys, column = columns
            ids, begins = encoder.encode([t or b"" for t in column.cast(pa.binary()).to_pylist()])
            out = [keys, [len(x) // 4 for x in ids], ids]
            return [*out, begins] if offsets else out

        return work

    dtype = docs.schema[key].dataType
    fields = [(key, to_arrow_type(dtype)), ("n_tokens", pa.int64()), ("token_ids", pa.binary())]
    schema = f"`{key}` {dtype.simpleString()}, n_tokens long, token_ids binary"
    if offsets:
        fields.append(("token_offsets", pa.binary()))
        schema += ", token_offsets binary"
    return map_rows(docs.select(F.col(key), F.col(text).cast("string")), make, schema, pa.schema(fields), AT_ONCE)


def decode_documents(encoded: DataFrame, key: str, ranks_file: str) -> DataFrame:
    """key, n_tokens, token_ids and the decoded bytes of rows made by encode_documents, whose
    offsets are used where they are there."""
    shipped = encoded.sparkSession.sparkContext.broadcast(file_bytes(ranks_file))
    offsets = ["token_offsets"] if "token_offsets" in encoded.columns else []

    def make():
        decoder = held(("bpe-decoder", ranks_file), lambda: Decoder(read_ranks(shipped.value)))

        def work(columns):
            keys, counts, ids, *begins = columns
            known = [[x or b"" for x in c.to_pylist()] for c in (ids, *begins)]
            return [keys, counts, ids, decoder.decode(*known)]

        return work

    dtype = encoded.schema[key].dataType
    arrow = pa.schema([(key, to_arrow_type(dtype)), ("n_tokens", pa.int64()), ("token_ids", pa.binary()), ("decoded", pa.binary())])
    schema = f"`{key}` {dtype.simpleString()}, n_tokens long, token_ids binary, decoded binary"
    return map_rows(encoded.select(key, "n_tokens", "token_ids", *offsets), make, schema, arrow)


def there_and_back(docs: DataFrame, key: str, text: str, ranks_file: str) -> DataFrame:
    """What decode_documents makes of encode_documents, in one Python worker a task: two in a
    row would hold two tables of ranks, and both workers live on."""
    shipped = docs.sparkSession.sparkContext.broadcast(file_bytes(ranks_file))

    def make():
        ranks = read_ranks(shipped.value)
        encoder, decoder = Encoder(ranks), held(("bpe-decoder", ranks_file), lambda: Decoder(ranks))

        def work(columns):
            keys, column = columns
            ids, begins = encoder.encode(texts(column))
            return [keys, [len(x) // 4 for x in ids], ids, decoder.decode(ids, begins)]

        return work

    dtype = docs.schema[key].dataType
    arrow = pa.schema([(key, to_arrow_type(dtype)), ("n_tokens", pa.int64()), ("token_ids", pa.binary()), ("decoded", pa.binary())])
    schema = f"`{key}` {dtype.simpleString()}, n_tokens long, token_ids binary, decoded binary"
    return map_rows(docs.select(F.col(key), F.col(text).cast("string")), make, schema, arrow, AT_ONCE)


def digests(docs: DataFrame, ranks_file: str | None = None) -> DataFrame:
    """doc_id, n_tokens, and the digests of ids and decoded bytes."""
    ranks_file = ranks_file or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return there_and_back(docs, "doc_id", "text", ranks_file).select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(scan(spark, sf_dir, "documents"))
