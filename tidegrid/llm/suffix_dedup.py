"""Removal of repeated byte strings with suffix blocks over a cover sample (operator 6).

Every byte that lies in a string of `length` bytes which also starts anywhere else, in
the same or another document, is removed.

*Cover sample.* Positions are sampled so that any two equal strings of `length` bytes
have a sampled position at the same offset: in every such string, the position whose
next ANCHOR bytes have the smallest hash, the first of them on ties. This is what a
difference cover does for suffixes, but the sample depends on content only, so it needs
1 position in 75 instead of 1 in 10, and two strings need comparing only if their
sampled positions have equal anchors. Anchors are counted before the shuffle; one that
occurs once cannot lie in a repeated string.

*Resolved at once.* A sampled position stands for a range of string starts. If the whole
text under the range occurs twice at that anchor, all its strings are repeated.

*Suffix blocks.* The others are cut out of their texts, once per distinct text, and dealt
into blocks by their anchor; one block is one group. In a block, the suffixes that begin
at the sampled positions are sorted, and so are the prefixes that end there, read
backwards; common prefix lengths of neighbours give each a rank at every depth. A string
that reaches `o` bytes back from its sampled position is told by two ranks of the sample,
backwards at depth o and forwards at depth length - o, however long the tie is. Memory
is that of one block.

*Very frequent anchors.* Anchors of more than BLOCK_ROWS positions, and more than
1 / HOT_SHARE of all (so fewer than HOT_SHARE anchors), are told apart by a broadcast
before anything is dealt by anchor, and equal texts under their ranges are added up before
the shuffle. Classes that still have more than BLOCK_ROWS different texts take another
exact way: the hashes of their strings are counted.

Texts and ranges are known by 64-bit hashes.

Defined cases: null texts are empty; texts shorter than `length` lose nothing; rows that
repeat a text lose all of it, if it is long enough; an empty table gives an empty result;
very long texts are sampled in pieces that overlap. Null and repeated keys are fine, as
rows meet by their text. Columns other than key and text are never read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidegrid.llm.common import Powers, join_checked, map_rows, mixed, scan, texts, written

LENGTH = 200
ANCHOR = 50
PIECE = 1 << 19
PLACE_BITS = 20
BLOCK_ROWS = 50_000
BLOCK_TARGET = 20_000
HOT_SHARE = 100_000
MAX_BROADCAST_RANGES = 100_000


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each window, from running minima of blocks in both directions."""
    pad = np.full(-len(values) % width, np.iinfo(np.uint64).max, np.uint64)
    grid = np.concatenate([values, pad]).reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: len(values) - width + 1], ahead[width - 1 : len(values)])


@dataclass
class Samples:
    """Sampled positions of one text: hash of the anchor, hash of the text under the
    range of starts, the position, and the first and last start."""

    anchor: np.ndarray
    under: np.ndarray
    at: np.ndarray
    low: np.ndarray
    high: np.ndarray


def place_of(s: Samples) -> np.ndarray:
    return (s.at << 16) | ((s.at - s.low) << 8) | (s.high - s.low)


def ranges(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = place >> 16
    low = at - ((place >> 8) & 255)
    return at, low, low + (place & 255)


def sample(text: bytes, powers: Powers, length: int = LENGTH, anchor: int = ANCHOR) -> Samples | None:
    data = np.frombuffer(text, np.uint8)
    if len(data) < length:
        return None
    width, found = length - anchor + 1, []
    for start in range(0, len(data) - length + 1, PIECE):
        part = data[start : start + PIECE + length - 1]
        sums = powers.sums(part)
        spots = np.arange(len(part) - anchor + 1)
        hashes = powers.between(sums, spots, spots + anchor)
        # the place in the low bits makes the first of equal hashes the least
        keyed = (hashes & ~np.uint64((1 << PLACE_BITS) - 1)) | spots.astype(np.uint64)
        least = (least_in_windows(keyed, width) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        low = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        high = np.append(low[1:], len(least)) - 1
        at = least[low]
        under = mixed(powers.between(sums, low, high + length) + (at - low).astype(np.uint64))
        found.append((hashes[at], under, at + start, low + start, high + start))
    return Samples(*(np.concatenate(c) for c in zip(*found)))


def sampled(docs: DataFrame, text: str, length: int, anchor: int) -> DataFrame:
    """_anchor, _under, _text, _place of every sampled position."""

    def make():
        powers = Powers()

        def work(columns):
            ids, column = columns
            out = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for name, content in zip(ids.to_pylist(), texts(column)):
                s = sample(content, powers, length, anchor)
                if s is not None:
                    for to, values in zip(out, (s.anchor.view(np.int64), s.under.view(np.int64), np.full(len(s.at), name), place_of(s))):
                        to.append(values)
            return [np.concatenate(c) for c in out]

        return work

    names = ["_anchor", "_under", "_text", "_place"]
    rows = docs.select(text_id(text), F.col(text).cast("string")).where(F.octet_length(F.col(text).cast("string")) >= length)
    return map_rows(rows, make, ", ".join(f"{c} long" for c in names), pa.schema([(c, pa.int64()) for c in names]))


def text_id(text: str) -> F.Column:
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("_text")


@dataclass(frozen=True)
class Candidates:
    """Positions whose anchor occurs twice or more, by what is left to do for them."""

    repeated: DataFrame  # the text under the range occurs twice: all its strings do
    unsolved: DataFrame  # one position of each other text of an ordinary class
    wide: DataFrame | None  # positions of classes with too many texts for a block


def candidates(positions: DataFrame, block_rows: int) -> Candidates:
    columns = positions.columns
    counts = written(positions.groupBy("_anchor").agg(F.count("*").alias("_class")).where("_class > 1"), "anchor-counts")
    total = counts.agg(F.sum("_class")).first()[0] or 0
    frequent = F.col("_class") > max(block_rows, total // HOT_SHARE)
    hot = written(counts.where(frequent).select("_anchor"), "hot-anchors")
    any_hot = hot.limit(1).count() > 0
    cold = positions.join(F.broadcast(hot), "_anchor", "left_anti") if any_hot else positions
    same = F.expr("count(*) OVER (PARTITION BY _anchor, _under)").alias("_times")
    first = F.expr("row_number() OVER (PARTITION BY _anchor, _under ORDER BY _text, _place) = 1").alias("_first")
    kept = written(cold.join(counts, "_anchor").select("*", same, first), "repeat-candidates")
    repeated = kept.where("_times > 1").select(*columns)
    unsolved = kept.where("_first AND _times < _class")
    large = unsolved.where(F.col("_class") > block_rows).select(*columns)
    unsolved = unsolved.where(F.col("_class") <= block_rows).select(*columns)
    wide = large if large.limit(1).count() else None
    if any_hot:
        # the most frequent anchors: equal texts are added up before the shuffle
        often = positions.join(F.broadcast(hot), "_anchor", "left_semi")
        sums = [F.count("*").alias("_times"), F.first("_text").alias("_text"), F.first("_place").alias("_place")]
        ranges = written(often.groupBy("_anchor", "_under").agg(*sums), "hot-ranges")
        widths = ranges.groupBy("_anchor").agg(F.count("*").alias("_ranges"))
        twice = ranges.where("_times > 1").select("_anchor", "_under")
        repeated = repeated.unionByName(join_checked(often, twice, ["_anchor", "_under"], "left_semi", MAX_BROADCAST_RANGES))
        open_ranges = ranges.join(widths, "_anchor").where("_ranges > 1")
        unsolved = unsolved.unionByName(open_ranges.where(F.col("_ranges") <= block_rows).select(*columns))
        many = open_ranges.where(F.col("_ranges") > block_rows).select(*columns)
        if many.limit(1).count():
            wide = many if wide is None else wide.unionByName(many)
    return Candidates(repeated, unsolved, wide)


def packed(anchors, names, places, cuts: list[bytes]) -> bytes:
    sizes = np.array([len(c) for c in cuts], "<i8")
    head = b"".join(np.asarray(a, "<i8").tobytes() for a in (anchors, names, places, sizes))
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(cuts))


def unpacked(blob: bytes, n: int) -> tuple[np.ndarray, list[bytes]]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    anchors, names, places, sizes = np.frombuffer(raw, "<i8", 4 * n).reshape(4, n)
    ends = 32 * n + np.cumsum(sizes)
    return np.stack([anchors, names, places]), [raw[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist())]


def cut_out(wanted: DataFrame, length: int, blocks: int) -> DataFrame:
    """_block, n, blob: the texts under the wanted ranges, packed by block."""

    def make():
        def work(columns):
            contents, wants = texts(columns[1]), columns[2].to_pylist()
            names = columns[0].to_pylist()
            rows: dict[int, list[tuple]] = {}
            for name, content, asked in zip(names, contents, wants):
                for want in asked:
                    _, low, high = ranges(np.int64(want["_place"]))
                    rows.setdefault(want["_anchor"] % blocks, []).append((want["_anchor"], name, want["_place"], content[low : high + length]))
            made = [(block, len(r), packed(*map(list, zip(*r)))) for block, r in rows.items()]
            return [list(c) for c in zip(*made)] or [[], [], []]

        return work

    arrow = pa.schema([("_block", pa.int64()), ("n", pa.int64()), ("blob", pa.binary())])
    return map_rows(wanted.select("_text", "content", "wants"), make, "_block long, n long, blob binary", arrow)


def depths(rows: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted order of byte rows within their owners, and the common prefix length of
    each with the one before (-1 at a new owner)."""
    keys = [o.tobytes() + r.tobytes() for o, r in zip(owner.astype(">u8"), rows)]
    order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
    ranked, whose = rows[order], owner[order]
    differ = ranked[1:] != ranked[:-1]
    common = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    common[whose[1:] != whose[:-1]] = -1
    return order, np.concatenate([[-1], common])


def repeated_starts(owner: np.ndarray, back: np.ndarray, span: np.ndarray, cuts: list[bytes], length: int) -> np.ndarray:
    """[row, start - low]: which strings of each range occur in another range of the same
    anchor. back: bytes before the sampled position; span: last start - first start."""
    n, reach = len(cuts), int(back.max())
    ahead_rows, back_rows = np.zeros((n, length), np.uint8), np.zeros((n, reach), np.uint8)
    for k, (cut, b) in enumerate(zip(cuts, back.tolist())):
        data = np.frombuffer(cut, np.uint8)
        right = data[b : b + length]
        ahead_rows[k, : len(right)] = right
        back_rows[k, :b] = data[:b][::-1]
    places, common = [], []
    for rows in (ahead_rows, back_rows):
        order, depth = depths(rows, owner)
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        places.append(place)
        common.append(depth)
    out = np.zeros((n, int(span.max()) + 1), bool)
    for o in range(reach + 1):
        # ranges that hold the string starting o bytes before their sampled position
        holds = np.flatnonzero((o <= back) & (o >= back - span))
        if len(holds) < 2:
            continue
        ahead = np.cumsum(common[0] < length - o)[places[0][holds]]
        behind = np.cumsum(common[1] < o)[places[1][holds]] if o else np.zeros(len(holds), np.int64)
        both = ahead * (n + 1) + behind
        _, where, times = np.unique(both, return_inverse=True, return_counts=True)
        again = holds[times[where] > 1]
        out[again, back[again] - o] = True
    return out


MASKS = pa.schema([("_text", pa.int64()), ("_place", pa.int64()), ("mask", pa.binary())])


def block_repeats(blocks: DataFrame, length: int) -> DataFrame:
    """_text, _place, mask: the repeated starts of each range, as bits."""

    def solve(group: pa.Table) -> pa.Table:
        seen: dict[tuple, bytes] = {}
        for n, blob in zip(group["n"].to_pylist(), group["blob"].to_pylist()):
            heads, cuts = unpacked(blob, n)
            seen.update(zip(map(tuple, heads.T.tolist()), cuts))
        anchors, names, places = np.array(list(seen), np.int64).T
        _, low, high = ranges(places)
        back = (places >> 8) & 255
        found = repeated_starts(anchors.view(np.uint64), back, high - low, list(seen.values()), length)
        hit = np.flatnonzero(found.any(1))
        bits = [np.packbits(found[k]).tobytes() for k in hit.tolist()]
        return pa.table([pa.array(names[hit]), pa.array(places[hit]), pa.array(bits, pa.binary())], schema=MASKS)

    return blocks.groupBy("_block").applyInArrow(solve, "_text long, _place long, mask binary")


def counted_repeats(wanted: DataFrame, length: int) -> DataFrame:
    """The same for very frequent anchors: hashes of their strings are counted."""

    def make():
        powers = Powers()

        def work(columns):
            names, contents, wants = columns[0].to_pylist(), texts(columns[1]), columns[2].to_pylist()
            out = [[np.empty(0, np.int64)] for _ in range(5)]
            for name, content, asked in zip(names, contents, wants):
                sums = powers.sums(np.frombuffer(content, np.uint8))
                for want in asked:
                    at, low, high = ranges(np.int64(want["_place"]))
                    starts = np.arange(low, high + 1)
                    hashes = powers.between(sums, starts, starts + length).view(np.int64)
                    given = [np.full(len(starts), v) for v in (want["_anchor"], name, want["_place"])]
                    for to, values in zip(out, (*given, at - starts, hashes)):
                        to.append(values)
            return [np.concatenate(c) for c in out]

        return work

    columns = ["_anchor", "_text", "_place", "_back", "_string"]
    strings = map_rows(wanted.select("_text", "content", "wants"), make, ", ".join(f"{c} long" for c in columns), pa.schema([(c, pa.int64()) for c in columns]))
    keys = ["_anchor", "_back", "_string"]
    # a range stands for all with its text, of which the other strings are known
    twice = strings.groupBy(*keys).agg(F.count("*").alias("_times")).where("_times > 1").select(*keys)
    return strings.join(twice, keys, "left_semi").select("_text", "_place", F.expr("(_place >> 16) - _back").alias("start"))


@dataclass(frozen=True)
class Removed:
    n_bytes: int
    spans: list[tuple[int, int]]
    kept: bytes


def removed(content: bytes, whole: list[int], masks: list[tuple[int, bytes]], starts: list[int], length: int) -> Removed:
    """What is left of a text, given its repeated strings."""
    data = np.frombuffer(content, np.uint8)
    edges = np.zeros(len(data) + 1, np.int64)
    if whole:
        _, low, high = ranges(np.array(whole, np.int64))
        np.add.at(edges, low, 1)
        np.add.at(edges, high + length, -1)
    for place, mask in masks:
        _, low, _ = ranges(np.int64(place))
        begin = low + np.flatnonzero(np.unpackbits(np.frombuffer(mask, np.uint8)))
        edges[begin] += 1
        edges[begin + length] -= 1
    for begin in set(starts):
        edges[begin] += 1
        edges[begin + length] -= 1
    gone = np.cumsum(edges)[:-1] > 0
    turns = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
    return Removed(len(data), list(zip(turns[::2].tolist(), turns[1::2].tolist())), data[~gone].tobytes())


def repeats(docs: DataFrame, text: str, length: int, anchor: int, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Distinct texts (_text, content), and per text its repeated strings (_text, hits)."""
    found = candidates(sampled(docs, text, length, anchor), block_rows)
    long_enough = docs.select(text_id(text), F.col(text).cast("string").alias("content")).where(F.octet_length("content") >= length)
    distinct = long_enough.groupBy("_text").agg(F.first("content").alias("content"))

    def with_text(rows: DataFrame) -> DataFrame:
        wants = rows.groupBy("_text").agg(F.collect_set(F.struct("_anchor", "_place")).alias("wants"))
        return distinct.join(wants, "_text")

    blocks = max(1, -(-found.unsolved.count() // BLOCK_TARGET))
    none = F.lit(None)
    parts = [
        found.repeated.select("_text", "_place", none.cast("binary").alias("mask"), none.cast("long").alias("start")),
        block_repeats(cut_out(with_text(found.unsolved), length, blocks), length).select("_text", "_place", "mask", none.cast("long").alias("start")),
    ]
    if found.wide is not None:
        parts.append(counted_repeats(with_text(found.wide), length).select("_text", "_place", none.cast("binary").alias("mask"), "start"))
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.unionByName(part)
    return distinct, hits.groupBy("_text").agg(F.collect_list(F.struct("_place", "mask", "start")).alias("hits"))


def apply_hits(joined: DataFrame, length: int, make_row, schema: str, arrow: pa.Schema) -> DataFrame:
    def make():
        def work(columns):
            rows = []
            for name, content, hits in zip(columns[0].to_pylist(), texts(columns[1]), columns[2].to_pylist()):
                hits = hits or []
                whole = [h["_place"] for h in hits if h["mask"] is None and h["start"] is None]
                masks = [(h["_place"], h["mask"]) for h in hits if h["mask"] is not None]
                rows.append((name, *make_row(removed(content, whole, masks, [h["start"] for h in hits if h["start"] is not None], length))))
            return [list(c) for c in zip(*rows)] or [[] for _ in arrow]

        return work

    return map_rows(joined.select("_text", "content", "hits"), make, schema, arrow)


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, anchor: int = ANCHOR, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256, one row per document."""
    distinct, hits = repeats(docs, text, length, anchor, block_rows)
    arrow = pa.schema([("_text", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def row(r: Removed):
        return sum(b - a for a, b in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()

    changed = apply_hits(distinct.join(hits, "_text"), length, row, "_text long, n_removed long, n_spans long, kept_sha256 string", arrow)
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key), text_id(text), F.octet_length(content).cast("long").alias("n_bytes"), F.sha2(content.cast("binary"), 256).alias("_whole"))
    rows = rows.join(changed, "_text", "left")
    return rows.select(
        key,
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "_whole").alias("kept_sha256"),
    )


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, anchor: int = ANCHOR, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All columns, the texts without their repeated bytes; what is left of a character
    that was cut is dropped, so that texts stay valid."""
    distinct, hits = repeats(docs, text, length, anchor, block_rows)
    arrow = pa.schema([("_text", pa.int64()), ("_kept", pa.string())])
    changed = apply_hits(distinct.join(hits, "_text"), length, lambda r: (r.kept.decode(errors="ignore"),), "_text long, _kept string", arrow)
    rows = docs.select(text_id(text), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")).join(changed, "_text", "left")
    return rows.select(*[F.coalesce("_kept", F.col("_row").getField(c)).alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in docs.columns])


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(scan(spark, sf_dir, "documents"))
