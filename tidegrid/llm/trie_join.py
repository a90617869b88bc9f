"""N-gram Jaccard join over prefix trees (operator 1).

A document's set holds the hashes of its distinct n-word shingles. Two documents link
when the Jaccard similarity of their sets reaches a threshold. Equal sets are one class
from the start, so copies cost one row each.

*Families.* If two sets differ in at most d shingles and the space of shingles is cut
into more than d parts, the sets agree on some part. Sizes are grouped, so that all sets
which can link share a number of parts (with SPARE and a share more, so that parts empty
in both need not count); a set sends one signature per part that holds shingles, and sets
that share a signature belong to one family. Few sets leave too many parts empty for that;
they also sign by finer parts. Shingles of very common passages would tie unlike sets
together at low thresholds, so they are found by a counting pass over all texts and left
out of signatures there. A family is a component of (set, smallest set with its signature).
Linked sets are always in one family. Nothing is emitted per pair.

*Candidates.* At low thresholds a set has many signatures, nearly all of them its own, so
sets without a partner are told first, by prefixes in a global order (frequent shingles
last). If two sets share o shingles, their first size - o + k share at least k. A set
stays a candidate if, of its first shingles, so many are also among those of other sets
(PREFIX_SHARE of its size, besides what may differ); only candidates send signatures.

*Prefix trees.* A family is dealt into blocks of bounded size, and each pair of blocks is
one group; pairs take turns, so that few copies of a set are on disk at once. One block's sets, in global order of their hashes, form a prefix tree whose
unbranched runs are one node; the other block's sets walk it all at once. The overlap
with the path to a node is shared by all sets below, and a walker leaves a subtree when
the overlap so far plus what can remain, in the tree or in the walker, is too small for
the smallest set below. What is left at the leaves are exact overlaps. A group returns
a spanning forest of its links and the number of links per set; the components of all
forests are the result.

A shingle is known by 64 bits, a set by 64 bits of a hash of its shingles.

Defined cases: null texts and texts without words have an empty set and link with
nothing, not even each other; a text of fewer than n words has its whole word sequence as
its only shingle; rows that repeat a document are linked like any copies; a null key is
never the smallest of a component (a component of null keys has a null id); an empty table
gives an empty result. Columns other than key and text are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidegrid.llm.common import WordHashes, gram_hashes, join_checked, map_rows, mixed, passing, scan, shuffles_removed, slices, small_batches, texts, written
from tidegrid.llm.components import components

# Parts more than needed, besides a share more: so many may be empty in a set. Sets that leave
# more of them empty sign by so many divisions, each into twice the parts.
SPARE = 2
DIVISIONS = 4
# Buckets of shingle hashes, the parts their counts are added up in, the share of all
# shingles above which a bucket is frequent, and the share of rare shingles to sign by them.
BUCKET_BITS = 22
BUCKET_PARTS = 64
FREQUENT = 1 << 19
RARE_SHARE = 0.5
# Shingles that have to be shared in a prefix, per shingle of the set, and the number of
# candidates up to which they are broadcast (as 64-bit numbers).
PREFIX_SHARE = 0.1
MAX_BROADCAST_SETS = 1_000_000
BLOCK_SETS = 800
BLOCK_SHINGLES = 400_000
# How often a round of block pairs sends each set on average, and what a set takes besides its
# shingles, as so many of them.
SENT = 3
SET_COST = 16
WALKERS = 128
# Bytes of text hashed at once: a worker keeps some of what a step took for the next stages.
AT_ONCE = 1 << 20


@dataclass(frozen=True)
class Likeness:
    """Link when den * intersection >= num * union, over shingles of n words."""

    n: int = 5
    num: int = 80
    den: int = 100
    # sign by rare shingles: at low thresholds a part holds few shingles, and common
    # passages would fill some; it takes a counting pass
    rare: bool = True

    def apart(self, x: int, y: int) -> int:
        """The most shingles in which linked sets of these sizes differ."""
        return (self.den - self.num) * (x + y) // (self.den + self.num)

    def overlap(self, x, y):
        """The least intersection of linked sets of these sizes."""
        return -(-self.num * (x + y) // (self.den + self.num))


def shingles(text: bytes, n: int, memory: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of one text."""
    words = memory.of(text.lower().split())
    if 0 < len(words) < n:
        return mixed(np.array([xxhash.xxh3_64_intdigest(words.tobytes(), len(words))], np.uint64))
    return np.unique(gram_hashes(words, n))


def set_name(grams: np.ndarray) -> int:
    return int(np.array(xxhash.xxh3_64_intdigest(grams.tobytes(), len(grams)), np.uint64).astype(np.int64)) if len(grams) else 0


def size_groups(like: Likeness, largest: int) -> list[int]:
    """Bounds of size groups, each at least 1 / threshold times the one before."""
    bounds = [1]
    while bounds[-1] <= largest:
        bounds.append(max(bounds[-1] + 1, -(-bounds[-1] * 3 // 2), -(-bounds[-1] * like.den // like.num)))
    return bounds


def bucket_of(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def frequent_buckets(docs: DataFrame, text: str, like: Likeness) -> np.ndarray:
    """Bits of the hash buckets that hold more than 1 / FREQUENT of all shingles.

    Every shingle of every text is counted, in a table of fixed size per task; the
    tables are added up part by part. Common passages end up in marked buckets.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, counts = WordHashes(), np.zeros(1 << BUCKET_BITS, np.int32)
        for batch in batches:
            for part in slices(batch, AT_ONCE):
                found = [shingles(t, like.n, memory) for t in texts(part.column(0))]
                if found:
                    at, times = np.unique(bucket_of(np.concatenate(found)), return_counts=True)
                    counts[at] += times
        parts = counts.reshape(BUCKET_PARTS, -1)
        rows = [(k, zlib.compress(p.astype("<i8").tobytes(), 1)) for k, p in enumerate(parts) if p.any()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), PARTS.types)], schema=PARTS)

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(x), "<i8") for x in group["counts"].to_pylist())
        return pa.table([[group["part"][0].as_py()], [zlib.compress(total.tobytes(), 1)]], schema=PARTS)

    rows = docs.select(F.col(text).cast("string")).mapInArrow(count, "part int, counts binary")
    table = np.zeros((BUCKET_PARTS, (1 << BUCKET_BITS) // BUCKET_PARTS), np.int64)
    with shuffles_removed(docs.sparkSession), small_batches(docs.sparkSession):
        # BUCKET_PARTS rows, of a size that does not depend on the data
        for row in rows.groupBy("part").applyInArrow(add, "part int, counts binary").collect():
            table[row["part"]] = np.frombuffer(zlib.decompress(bytes(row["counts"])), "<i8")
    return table.ravel() > max(1.0, table.sum() / FREQUENT)


class Signer:
    """Signatures of sets, taken from their rare shingles.

    Leaving frequent shingles out of both sets does not make them differ in more. A set
    with few rare ones is signed by all of its shingles instead; the shares of rare ones
    of two linked sets differ by at most 1 - threshold, so sets between the two cases,
    which are signed both ways, keep every link.
    """

    def __init__(self, like: Likeness, frequent: np.ndarray | None = None) -> None:
        self.like, self.bounds, self.frequent = like, size_groups(like, 1 << 40), frequent

    def sign(self, grams: np.ndarray) -> np.ndarray:
        size = len(grams)
        rare = grams if self.frequent is None else grams[~self.frequent[bucket_of(grams)]]
        group = int(np.searchsorted(self.bounds, size, "right")) - 1
        groups = [group]
        # a partner of the next group must be close enough in size
        if size * self.like.den >= self.bounds[group + 1] * self.like.num:
            groups.append(group + 1)
        out = []
        share, apart = len(rare) / size, 1 - self.like.num / self.like.den
        if share >= RARE_SHARE:
            out += [self.in_group(rare, g) for g in groups]
        if share < RARE_SHARE + apart + 1e-9 and self.frequent is not None:
            out += [mixed(self.in_group(grams, g) + np.uint64(1)) for g in groups]
        return np.concatenate(out)

    def prefix(self, grams: np.ndarray) -> tuple[int, np.ndarray]:
        """How many of the set's first shingles any partner shares, and these shingles.

        A smaller partner has a shorter prefix: the smallest one decides how many.
        """
        size = len(grams)
        least = -(-self.like.num * size // self.like.den)
        first = size - least + max(1, int(size * PREFIX_SHARE))
        shared = max(1, int(least * PREFIX_SHARE))
        order = mixed(grams ^ np.uint64(0xD6E8FEB86659FD93))
        if self.frequent is not None:
            order = (order >> np.uint64(1)) | (self.frequent[bucket_of(grams)].astype(np.uint64) << np.uint64(63))
        return shared, grams[np.argpartition(order, first - 1)[:first]] if first < size else grams

    def in_group(self, grams: np.ndarray, group: int) -> np.ndarray:
        """Signatures by parts; equal sets alone link where no shingle may differ.

        If more parts are filled than may differ, one that is filled agrees with each
        partner, whatever the partner fills. A set that fills fewer also signs by twice the
        parts, and so on up to its single shingles: two linked sets share a filled part at
        the first division that suits one of them. Parts empty in both tell nothing of two
        sets, and would tie most of such sets together, so they sign only for sets of no
        more shingles than may differ.
        """
        top = self.bounds[group + 1] - 1
        apart = self.like.apart(top, top)
        if apart == 0:
            return np.empty(0, np.uint64)
        parts = apart + 1 + SPARE + apart // (4 if self.like.rare else 64)
        hashes, out = mixed(grams + np.uint64(group + 1)), []
        for level in range(DIVISIONS):
            used, sums = self.filled(grams, hashes, parts << level)
            out.append(self.placed(group, level, used, sums))
            if len(used) > apart:
                return np.concatenate(out)
        out.append(self.placed(group, DIVISIONS, np.zeros(len(grams)), mixed(grams)))
        if len(grams) <= apart:
            empty = np.setdiff1d(np.arange(parts), self.filled(grams, hashes, parts)[0])
            out.append(self.placed(group, 0, empty, np.zeros(len(empty), np.uint64)))
        return np.concatenate(out)

    @staticmethod
    def filled(grams: np.ndarray, hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """The parts that hold shingles, and a hash of what they hold."""
        part = (hashes % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        used, first = np.unique(part[order], return_index=True)
        return used, np.add.reduceat(mixed(grams[order]), first) if len(used) else np.empty(0, np.uint64)

    @staticmethod
    def placed(group: int, level: int, used: np.ndarray, sums: np.ndarray) -> np.ndarray:
        place = np.uint64((group << 40) + (level << 36)) + used.astype(np.uint64)
        return mixed(sums ^ mixed(place + np.uint64(0x5851F42D4C957F2D)))


def hashed(docs: DataFrame, key: str, text: str, like: Likeness, frequent, prefixes: bool) -> DataFrame:
    """_key, _set (null for an empty set), n_shingles, _shared, _hashes of each row.

    The hashes are the set's signatures, or its first shingles, of which `_shared` are also
    a partner's. `frequent` is the broadcast bits of frequent buckets (of None where all are
    signed alike).
    """
    dtype = docs.schema[key].dataType

    def make():
        bits = frequent.value
        memory, signer = WordHashes(), Signer(like, None if bits is None else np.unpackbits(bits).astype(bool))

        def one(grams: np.ndarray) -> tuple[int | None, np.ndarray]:
            if not len(grams):
                return None, grams
            return signer.prefix(grams) if prefixes else (None, signer.sign(grams))

        def work(columns):
            keys, column = columns
            sets = [shingles(t, like.n, memory) for t in texts(column)]
            shared, hashes = zip(*map(one, sets)) if sets else ((), ())
            edges = np.cumsum([0] + [len(h) for h in hashes], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(hashes).view(np.int64) if sets else np.empty(0, np.int64)))
            return [keys, [set_name(s) if len(s) else None for s in sets], [len(s) for s in sets], list(shared), lists]

        return work

    fields = [("_key", to_arrow_type(dtype)), ("_set", pa.int64()), ("n_shingles", pa.int64()), ("_shared", pa.int64()), ("_hashes", pa.list_(pa.int64()))]
    schema = f"_key {dtype.simpleString()}, _set long, n_shingles long, _shared long, _hashes array<long>"
    return map_rows(docs.select(F.col(key), F.col(text).cast("string")), make, schema, pa.schema(fields), AT_ONCE)


def met_elsewhere(rows: DataFrame, folder: str) -> DataFrame:
    """_set, _hash, _hub (smallest set) of the hashes that several sets have."""
    hashes = rows.where("_set IS NOT NULL").select("_set", F.explode("_hashes").alias("_hash"))
    hubs = hashes.groupBy("_hash").agg(F.min("_set").alias("_hub"), F.max("_set").alias("_other")).where("_hub <> _other")
    return hashes.join(written(hubs.select("_hash", "_hub"), "hash-hubs", folder), "_hash")


def candidates(rows: DataFrame) -> DataFrame:
    """_set, _key (smallest) of the sets that share enough of their prefix with others to
    have a partner; computed."""
    with passing(rows.sparkSession, "hash-hubs") as folder:
        found = met_elsewhere(rows, folder).groupBy("_set").agg(F.count("*").alias("_met"))
        # copies of a set meet alike: each counts as often as the set has rows
        sets = rows.groupBy("_set").agg(F.min("_shared").alias("_shared"), F.count("*").alias("_rows"), F.min("_key").alias("_key"))
        return sets.join(found, "_set").where("_met >= _shared * _rows").select("_set", "_key").checkpoint()


def families(rows: DataFrame) -> DataFrame:
    """_set, _family of the sets that share a signature with another set; computed."""
    with passing(rows.sparkSession, "hash-hubs") as folder:
        edges = met_elsewhere(rows, folder).where("_set <> _hub").select(F.col("_set").alias("a"), F.col("_hub").alias("b"))
        found = components(edges)
    return found.select(F.col("node").alias("_set"), F.col("root").alias("_family"))


def signing_documents(docs: DataFrame, key: str, found: DataFrame) -> DataFrame:
    """The rows of the keys found; a null key is one too."""
    keys = found.select(F.struct("_key").alias("_named")).distinct()
    named = docs.withColumn("_named", F.struct(F.col(key).alias("_key")))
    return join_checked(named, keys, ["_named"], "left_semi", MAX_BROADCAST_SETS)


class Tree:
    """A prefix tree of sets of ranks: sorted sets, the length each shares with the one
    before, and for each length at which sets branch off, the sets below."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        self.sets = [sets[i] for i in self.order]
        self.shared = [0]
        for a, b in zip(self.sets, self.sets[1:]):
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            self.shared.append(int(differ[0]) if len(differ) else n)
        self.sizes = np.array([len(s) for s in self.sets])

    def below(self, at: int, depth: int) -> int:
        """The end of the run of sets from `at` on that share their first `depth` ranks."""
        end = at + 1
        while end < len(self.sets) and self.shared[end] >= depth:
            end += 1
        return end

    def overlaps(self, member: np.ndarray, ranks: list[np.ndarray], like: Likeness) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(set, walkers, intersections) for the linked pairs; member[rank, walker]."""
        sizes = np.array([len(r) for r in ranks])
        # a node: depth, the walkers still on it, their overlap with the path
        path = [(0, np.arange(len(ranks)), np.zeros(len(ranks), np.int64))]
        at = 0
        while at < len(self.sets):
            while path[-1][0] > self.shared[at]:
                path.pop()
            depth, here, overlap = path[-1]
            branch = self.shared[at + 1] if at + 1 < len(self.sets) else 0
            own = self.sets[at]
            if branch > depth:
                # the node where the next set leaves this one
                here, overlap = self.step(own[depth:branch], here, overlap, member)
                end = self.below(at, branch)
                low, high = self.sizes[at:end].min(), self.sizes[at:end].max()
                passed = np.array([np.searchsorted(ranks[w], own[branch - 1], "right") for w in here.tolist()], np.int64)
                rest = np.minimum(high - branch, sizes[here] - passed)
                stay = overlap + rest >= like.overlap(low, sizes[here])
                here, overlap, depth = here[stay], overlap[stay], branch
                path.append((depth, here, overlap))
                if not len(here):
                    at = end
                    continue
            if len(here):
                # no walker can gain more than what is left of this set
                stay = overlap + (len(own) - depth) >= like.overlap(len(own), sizes[here])
                here, overlap = self.step(own[depth:], here[stay], overlap[stay], member)
                linked = overlap >= like.overlap(len(own), sizes[here])
                if linked.any():
                    yield self.order[at], here[linked], overlap[linked]
            at += 1

    @staticmethod
    def step(run: np.ndarray, here: np.ndarray, overlap: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(here) and len(run):
            rows = member[run]
            overlap = overlap + (rows if len(here) == member.shape[1] else rows[:, here]).sum(0, dtype=np.int64)
        return here, overlap


def linked(tree_sets: list[np.ndarray], walkers: list[np.ndarray], like: Likeness) -> Iterator[tuple[int, int]]:
    """Pairs (tree set, walker) that link, by their places."""
    ranks_of = np.unique(np.concatenate(tree_sets))
    tree = Tree([np.searchsorted(ranks_of, s) for s in tree_sets])
    for at in range(0, len(walkers), WALKERS):
        part = walkers[at : at + WALKERS]
        member = np.zeros((len(ranks_of), len(part)), np.uint8)
        ranks = []
        for k, w in enumerate(part):
            place = np.searchsorted(ranks_of, w)
            known = place[place < len(ranks_of)]
            known = known[ranks_of[known] == w[: len(known)]]
            member[known, k] = 1
            # ranks of all shingles: those the tree lacks count towards size, not overlap
            ranks.append(place)
        for one, others, _ in tree.overlaps(member, ranks, like):
            for other in others.tolist():
                yield one, at + other


def join_blocks(names: list[list[int]], sets: list[list[np.ndarray]], copies: list[dict[int, int]], like: Likeness):
    """Spanning forest and number of linked documents per set, of one pair of blocks."""
    one, two = (0, 0) if len(names) == 1 else (0, 1)
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    forest, degree = [], {}
    if names[one] and names[two]:
        for i, j in linked(sets[one], sets[two], like):
            a, b = names[one][i], names[two][j]
            if a == b:
                continue
            degree[a] = degree.get(a, 0) + copies[two][b]
            if one != two:
                degree[b] = degree.get(b, 0) + copies[one][a]
            if top(a) != top(b):
                parent[top(a)] = top(b)
                forest.append((a, b))
    return forest, degree


def tree_links(docs: DataFrame, rows: DataFrame, family: DataFrame, key: str, text: str, like: Likeness) -> DataFrame:
    """a, b, n_links: links of a spanning forest (n_links null), and counts (b null); written.

    A set is sent once for each block of its family, so large families are joined in rounds
    that send each set SENT times on average; a round's shuffle goes before the next one.
    """
    # one document stands for each set of a family; its text is read once more
    members = rows.join(family, "_set").groupBy("_set", "_family", "n_shingles").agg(F.min("_key").alias("_key"), F.count("*").alias("_copies"))
    sizes = members.groupBy("_family").agg(F.count("*").alias("_sets"), F.sum("n_shingles").alias("_shingles"))
    wide = F.greatest(F.ceil(F.col("_sets") / BLOCK_SETS), F.ceil(F.col("_shingles") / BLOCK_SHINGLES)).cast("int")
    sizes = sizes.select("_family", wide.alias("_blocks"), (F.col("_shingles") + SET_COST * F.col("_sets")).alias("_cost")).checkpoint()
    placed = members.join(sizes.select("_family", "_blocks"), "_family")
    placed = placed.withColumn("_block", F.pmod(F.xxhash64("_set"), "_blocks").cast("int")).checkpoint()
    content = signing_documents(docs, key, placed).select(F.col(key).alias("_doc"), F.col(text).cast("string").alias("_text"))
    placed = placed.join(content, F.col("_key").eqNullSafe(F.col("_doc"))).select("_set", "_family", "_copies", "_blocks", "_block", "_text")

    def make():
        memory = WordHashes()

        def work(columns):
            *rest, column = columns
            sets = [shingles(t, like.n, memory) for t in texts(column)]
            return [*rest, [set_name(s) for s in sets], [s.astype("<u8").tobytes() for s in sets]]

        return work

    head = "_set long, _family long, _copies long, _blocks int, _block int"
    fields = [("_set", pa.int64()), ("_family", pa.int64()), ("_copies", pa.int64()), ("_blocks", pa.int32()), ("_block", pa.int32())]
    arrow = pa.schema([*fields, ("_is", pa.int64()), ("_grams", pa.binary())])
    sets = map_rows(placed, make, head + ", _is long, _grams binary", arrow, AT_ONCE).where("_is = _set").drop("_is")
    once, sent = sizes.agg(F.sum("_cost"), F.sum(F.col("_cost") * F.col("_blocks"))).first()
    rounds = -(-sent // (SENT * once)) if once else 1

    def paired(sets: DataFrame, at: int) -> DataFrame:
        """The sets once for each pair of blocks whose numbers add up to `at` modulo `rounds`."""
        first = F.pmod(F.lit(at) - F.col("_block"), F.lit(rounds))
        others = F.when(first < F.col("_blocks"), F.sequence(first, F.col("_blocks") - 1, F.lit(rounds)))
        return sets.withColumn("_with", F.explode(others)).select(
            "_set", "_copies", "_grams", "_block", "_family", F.least("_block", "_with").alias("_i"), F.greatest("_block", "_with").alias("_j")
        )

    def join(group: pa.Table) -> pa.Table:
        blocks: dict[int, dict[int, tuple[int, np.ndarray]]] = {}
        for row in group.select(["_set", "_copies", "_grams", "_block"]).to_pylist():
            blocks.setdefault(row["_block"], {})[row["_set"]] = row["_copies"], np.frombuffer(row["_grams"], "<u8")
        if len(blocks) == 1 and group["_i"][0].as_py() != group["_j"][0].as_py():
            return OUT.empty_table()
        order = [sorted(b.items()) for _, b in sorted(blocks.items())]
        forest, degree = join_blocks([[s for s, _ in b] for b in order], [[g for _, (_, g) in b] for b in order], [{s: c for s, (c, _) in b} for b in order], like)
        a = [x for x, _ in forest] + list(degree)
        b = [y for _, y in forest] + [None] * len(degree)
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array([None] * len(forest) + list(degree.values()), pa.int64())], schema=OUT)

    def joined(sets: DataFrame, at: int) -> DataFrame:
        return written(paired(sets, at).groupBy("_family", "_i", "_j").applyInArrow(join, "a long, b long, n_links long"), "tree-links")

    if rounds == 1:
        return joined(sets, 0)
    with passing(docs.sparkSession, "tree-sets") as folder:
        sets = written(sets, "tree-sets", folder)
        return reduce(DataFrame.union, [joined(sets, at) for at in range(rounds)])


PARTS = pa.schema([("part", pa.int32()), ("counts", pa.binary())])
OUT = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n_links", pa.int64())])


def resolved(docs: DataFrame, like: Likeness, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The rows (_key, _set, n_shingles), and the distinct sets that are not empty with their
    component (_root), smallest key, number of rows and links."""
    bits = np.packbits(frequent_buckets(docs, text, like)) if like.rare else None
    frequent = docs.sparkSession.sparkContext.broadcast(bits)
    with passing(docs.sparkSession, "set-hashes") as folder:
        rows = written(hashed(docs, key, text, like, frequent, like.rare), "set-hashes", folder)
        narrow = written(rows.select("_key", "_set", "n_shingles"), "shingle-sets")
        # both end in a checkpoint, so the hashes have served
        if like.rare:
            chosen = candidates(rows)
        else:
            family = families(rows)
    if like.rare:
        with passing(docs.sparkSession, "set-signs") as folder:
            signing = hashed(signing_documents(docs, key, chosen), key, text, like, frequent, False)
            family = families(written(signing.join(chosen.select("_set"), "_set", "left_semi"), "set-signs", folder))
    found = tree_links(docs, narrow, family, key, text, like)
    roots = components(found.where("b IS NOT NULL").select("a", "b"))
    degrees = found.where("n_links IS NOT NULL").groupBy(F.col("a").alias("_set")).agg(F.sum("n_links").alias("_links"))
    sets = narrow.where("_set IS NOT NULL").groupBy("_set").agg(F.min("_key").alias("_least"), F.count("*").alias("_copies"))
    sets = sets.join(roots.withColumnRenamed("node", "_set"), "_set", "left").join(degrees, "_set", "left")
    return narrow, sets.select("_set", F.coalesce("root", "_set").alias("_root"), "_least", "_copies", F.coalesce("_links", F.lit(0)).alias("_links"))


def linked_documents(docs: DataFrame, like: Likeness, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_shingles, component_id (smallest key), n_links (the
    documents it links with, copies included)."""
    narrow, sets = resolved(docs, like, key, text)
    least = sets.groupBy("_root").agg(F.min("_least").alias("_component"))
    named = sets.join(least, "_root").select("_set", "_component", (F.col("_links") + F.col("_copies") - 1).alias("_links"))
    full = narrow.where("_set IS NOT NULL").join(named, "_set").select(F.col("_key").alias(key), "n_shingles", F.col("_component").alias("component_id"), F.col("_links").alias("n_links"))
    empty = narrow.where("_set IS NULL").select(F.col("_key").alias(key), "n_shingles", F.col("_key").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return full.union(empty)


def named_sets(docs: DataFrame, key: str, text: str, like: Likeness) -> DataFrame:
    """_key, _set (0 for an empty set) and all columns of the rows as _row."""
    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    kinds = {f.name: f.dataType for f in rows.schema.fields}

    def make():
        memory = WordHashes()
        return lambda columns: [columns[0], [set_name(shingles(t, like.n, memory)) for t in texts(columns[1])], columns[2]]

    arrow = pa.schema([("_key", to_arrow_type(kinds["_key"])), ("_set", pa.int64()), ("_row", to_arrow_type(kinds["_row"]))])
    schema = T.StructType([T.StructField("_key", kinds["_key"]), T.StructField("_set", T.LongType()), T.StructField("_row", kinds["_row"])])
    return map_rows(rows, make, schema, arrow, AT_ONCE)


def keep_one(docs: DataFrame, like: Likeness = Likeness(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of one document of each component: that of the smallest key, and of its
    rows in the component that of the smallest set.

    What is judged is a key with a set of shingles: rows of one key with unlike texts are
    judged apart, each in its own component, and empty texts of a key by themselves. Rows
    equal in key and set are reduced to the first by a hash of all columns. Rows with a null
    key cannot be named by a decision; they stay.
    """
    narrow, sets = resolved(docs, like, key, text)
    best = sets.where("_least IS NOT NULL").groupBy("_root").agg(F.min(F.struct("_least", "_set")).alias("b"))
    empty = narrow.where("_set IS NULL AND _key IS NOT NULL").select("_key", F.lit(0).cast("long").alias("_set")).distinct()
    kept = best.select(F.col("b._least").alias("_key"), F.col("b._set").alias("_set")).union(empty)
    rows = narrow.where("_key IS NOT NULL").groupBy("_key").agg(F.count("*").alias("_rows"))
    kept = kept.join(rows, "_key").checkpoint()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    named = docs.where(F.col(key).isNotNull())
    alone = kept.where("_rows = 1").select(F.col("_key").alias(key))
    single = join_checked(named, alone, [key], "left_semi", MAX_BROADCAST_SETS).select(*columns)
    # a key of several rows: only these texts are looked at again
    several = rows.where("_rows > 1").select(F.col("_key").alias(key))
    repeated = named_sets(join_checked(named, several, [key], "left_semi", MAX_BROADCAST_SETS).select(*columns), key, text, like)
    chosen = repeated.join(kept.drop("_rows"), ["_key", "_set"], "left_semi")
    first = chosen.groupBy("_key", "_set").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row"))
    return single.union(first.select("_row.*").select(*columns)).union(docs.where(F.col(key).isNull()).select(*columns))


def op1_trie_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_documents(scan(spark, sf_dir, "documents"), Likeness(3, 90, 100, rare=False))


ORACLE = r"""
WITH RECURSIVE split AS (
  SELECT doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id,
         CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
              ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS grams
  FROM split
), grams AS (
  SELECT doc_id, len(grams) AS size, unnest(grams) AS gram FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.size, b.size
  HAVING 100 * count(*) >= 90 * (a.size + b.size - count(*))
), reached AS (
  SELECT a, b FROM links
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), least AS (
  SELECT a, min(b) AS b FROM reached GROUP BY a
), degrees AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT s.doc_id, len(grams)::BIGINT AS n_shingles, least(s.doc_id, coalesce(m.b, s.doc_id)) AS component_id,
       coalesce(d.n, 0)::BIGINT AS n_links
FROM sets s LEFT JOIN least m ON m.a = s.doc_id LEFT JOIN degrees d ON d.a = s.doc_id
"""
