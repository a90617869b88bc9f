"""Conversation prefix trie by hashing of fixed-length blocks of turns (operator 11).

A node stands for a distinct sequence of first turns (role and text); conversations that
begin with it are its members.

*Blocks.* Every conversation is cut into blocks of BLOCK turns. A prefix is named by two
64-bit lanes: the exclusive or, over its blocks, of hashes of the block's number, length
and turns. These names add up in any grouping, so also one very long conversation is
named in pieces. Conversations are grouped by the names of their successive blocks'
ends; a group ("class") is one row from then on, however many copies it has.

*Turns.* Where all members of a node go through one and the same next block, the turns
inside need no comparison: they are nodes with the class's members. Only where classes
diverge under one node are their blocks taken apart into turns, and equal ones grouped.

*Subtrees.* A node is owned by its smallest member. A member's words from a node on that
it does not own are what the others save, so a node's saved tokens are the sum over its
members of (words of the turns they do not own) - (words before the node), where
positive; its leaves are the members that own a childless node. Both are sums over
members, made by block and class like the counts, and no step walks the tree.

Skew: hot classes are added up before they are shuffled; no join has a side with many
rows of a key, but that of children to parents, where the at most HOT parents which have
more than 1 / HOT of all nodes as children are joined by a broadcast. Turns are numbered
by a range sort, which cuts long conversations, and chained in pieces of CHUNK blocks.
The checksum of a node's last members is sequential by nature: it is fed with joined
pieces of ids, in order, and never holds more than a batch of them.

Defined cases: null role and text are empty; turns are ordered by turn (null first), ties
by role, then by a digest of role and text, and repeated rows are turns of their own; rows
with a null key belong to no conversation and are left out; texts of any length are
known by 120 bits of their digest; an empty table has no node. Columns other than the
four named are never read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import ExitStack

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.llm.common import passing, scan, shuffles_removed, written
from tidegrid.session import ensure_checkpoint_dir

# Turns per block, blocks per piece of a chain, ids per piece of a checksum's input, and
# the share of nodes above which a parent's children are joined apart.
BLOCK = 4
CHUNK = 1_024
IDS = 256
HOT = 1_000
WORD = r"[^\x20\x09-\x0D]+"

STEPS = range(1, BLOCK + 1)
# Fixed columns of a block's class; all its rows agree on them.
SAME = ["block", "turns", "px", "py", "before", *[f"{c}{j}" for j in STEPS for c in "xyw"]]


def numbered(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """_c, _at, _part and the turn's digest (a, b) and words, in order within partitions."""
    who, what = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.md5(F.concat(F.char_length(who).cast("string"), F.lit(":"), who, what))
    order = ["_c", "_turn", "_role", "a", "b"]
    return (
        turns.where(F.col(key).isNotNull())
        .select(
            F.col(key).alias("_c"),
            F.col(turn).alias("_turn"),
            who.alias("_role"),
            F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("a"),
            F.conv(F.substring(digest, 16, 15), 16, 10).cast("long").alias("b"),
            F.size(F.regexp_extract_all(what, F.lit(WORD), F.lit(0))).cast("long").alias("words"),
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("_c", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at"), "a", "b", "words")
    )


def positions(rows: DataFrame) -> DataFrame:
    """The rows of `numbered`, written, with their place in the conversation from 0."""
    runs = rows.groupBy("_c", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("_c").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = runs.select("_c", "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return rows.join(placed, ["_c", "_part"]).select("_c", (F.col("_at") - F.col("_first") + F.col("_offset")).alias("pos"), "a", "b", "words")


def in_pieces(convs: DataFrame, rows: Column, piece: int) -> DataFrame:
    """Each conversation once for every piece of its rows, so that no join has a hot key."""
    return convs.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.floor(F.greatest(rows - 1, F.lit(0)) / piece))))


def own_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are: (_c, _turns) and (_c, pos, a, b, words)."""
    return turns.groupBy("_c").agg(F.count("*").alias("_turns")), turns


def shared_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the first turns of every twentieth, as op11 has them.

    The first h turns of c are those of c - c % 20, where h is c's checksum modulo 4.
    """
    convs = turns.groupBy("_c").agg(F.count("*").alias("_own"))
    convs = convs.select("_c", "_own", (F.crc32(F.col("_c").cast("string")) % 4).alias("_h"), (F.col("_c") - F.col("_c") % 20).alias("_base"))
    # at most three turns of a conversation
    first = turns.where("_c % 20 = 0 AND pos < 3").groupBy(F.col("_c").alias("_base")).agg(F.sort_array(F.collect_list(F.struct("pos", "a", "b", "words"))).alias("_head"))
    convs = convs.join(first, "_base", "left").withColumn("_take", F.least("_h", F.coalesce(F.size("_head"), F.lit(0)).cast("long")))
    borrowed = convs.where("_take > 0").select("_c", F.explode(F.slice("_head", 1, F.col("_take").cast("int"))).alias("t")).select("_c", "t.*")
    pieces = in_pieces(convs.select("_c", "_own", "_h", "_take"), F.col("_own"), CHUNK).drop("_own")
    kept = turns.withColumn("_piece", F.floor(F.col("pos") / CHUNK)).join(pieces, ["_c", "_piece"]).where("pos >= _h")
    kept = kept.select("_c", (F.col("pos") - F.col("_h") + F.col("_take")).alias("pos"), "a", "b", "words")
    return convs.select("_c", (F.col("_take") + F.greatest(F.col("_own") - F.col("_h"), F.lit(0))).alias("_turns")), kept.unionByName(borrowed)


def blocks_of(turns: DataFrame) -> DataFrame:
    """One row per block of a conversation: names (x, y) and words (w) of its turns, the
    name (px, py) and the words before it."""
    j = F.col("pos") % BLOCK
    cells = [F.max(F.when(j == k - 1, F.col(c))).alias(f"{c}{k}") for k in STEPS for c in ("a", "b", "words")]
    rows = turns.groupBy("_c", F.floor(F.col("pos") / BLOCK).alias("block")).agg(F.count("*").cast("int").alias("turns"), *cells)

    def lane(salt: int, k: int) -> Column:
        digests = [F.col(f"{c}{i}") for i in range(1, k + 1) for c in ("a", "b")]
        return F.when(F.col("turns") >= k, F.xxhash64(F.lit(salt), "block", F.lit(k), *digests))

    lanes = [lane(salt, k).alias(f"_{c}{k}") for k in STEPS for salt, c in enumerate("xy")]
    words = [F.coalesce(F.col(f"words{k}"), F.lit(0).cast("long")).alias(f"w{k}") for k in STEPS]
    rows = rows.select("_c", "block", "turns", F.floor(F.col("block") / CHUNK).alias("_piece"), *lanes, *words)
    whole = {c: F.coalesce(*[F.col(f"_{c}{k}") for k in reversed(STEPS)]) for c in "xy"}
    rows = rows.withColumn("_x", whole["x"]).withColumn("_y", whole["y"]).withColumn("_w", sum((F.col(f"w{k}") for k in STEPS), F.lit(0)))
    sums = {"x": F.bit_xor("_x"), "y": F.bit_xor("_y"), "w": F.sum("_w")}
    zero = F.lit(0).cast("long")
    within = Window.partitionBy("_c", "_piece").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("_c").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = rows.groupBy("_c", "_piece").agg(*[s.alias(f"_{c}") for c, s in sums.items()])
    pieces = pieces.select("_c", "_piece", *[F.coalesce(s.over(earlier), zero).alias(f"_{c}_piece") for c, s in sums.items()])
    chained = rows.select("*", *[F.coalesce(s.over(within), zero).alias(f"_{c}_own") for c, s in sums.items()]).join(pieces, ["_c", "_piece"])
    chained = chained.withColumn("px", F.expr("_x_own ^ _x_piece")).withColumn("py", F.expr("_y_own ^ _y_piece"))
    names = [F.expr(f"p{c} ^ _{c}{k}").alias(f"{c}{k}") for k in STEPS for c in "xy"]
    out = chained.select("_c", "_piece", "block", "turns", "px", "py", (F.col("_w_own") + F.col("_w_piece")).alias("before"), *names, *[f"w{k}" for k in STEPS])
    return out.withColumn("ex", F.coalesce(*[F.col(f"x{k}") for k in reversed(STEPS)])).withColumn("ey", F.coalesce(*[F.col(f"y{k}") for k in reversed(STEPS)]))


def words_before(k: int) -> Column:
    return sum((F.col(f"w{i}") for i in range(1, k)), F.col("before"))


def turns_of(classes: DataFrame, *each: list[Column]) -> DataFrame:
    """A row for each turn of the blocks, with the columns that `each` has for its place."""
    structs = []
    for k in STEPS:
        parent = ("px", "py") if k == 1 else (f"x{k - 1}", f"y{k - 1}")
        fixed = [F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y"), F.col(parent[0]).alias("ux"), F.col(parent[1]).alias("uy")]
        structs.append(F.struct(*fixed, (F.col("block") * BLOCK + k).alias("depth"), F.col(f"w{k}").alias("words"), words_before(k).alias("before"), *[c[k - 1] for c in each]))
    return classes.select(F.explode(F.slice(F.array(*structs), F.lit(1), F.col("turns"))).alias("n")).select("n.*")


FIXED = ("ux", "uy", "depth", "words", "before")


def refined(alone: DataFrame, diverged: DataFrame, each: list[list[Column]], sums: dict[str, Column]) -> DataFrame:
    """Nodes (x, y and the fixed columns) with sums; equal turns are grouped where classes diverge."""
    parts = turns_of(diverged, *each).groupBy("x", "y").agg(*[F.min(c).alias(c) for c in FIXED], *[s.alias(n) for n, s in sums.items()])
    return turns_of(alone, *each).select("x", "y", *FIXED, *sums).unionByName(parts)


def ends_digest(ends: DataFrame) -> DataFrame:
    """x, y, ends_sha256: checksum of the ids of (x, y, _c), ascending, joined by commas."""
    pieces = ends.groupBy("x", "y", F.floor(F.col("_c") / IDS).alias("_piece")).agg(F.array_join(F.sort_array(F.collect_list("_c")), ",").alias("_ids"))
    ordered = pieces.repartition("x", "y").sortWithinPartitions("x", "y", "_piece").select("x", "y", "_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None
        for batch in batches:
            done = []
            for x, y, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (x, y) != name:
                    if name is not None:
                        done.append((*name, state.hexdigest()))
                    name, state = (x, y), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), SHA.types)], schema=SHA)
        if name is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*name, state.hexdigest()), SHA.types)], schema=SHA)

    return ordered.mapInArrow(run, "x long, y long, ends_sha256 string")


SHA = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("ends_sha256", pa.string())])


def prefix_trie(
    turns: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    rebuild=own_turns,
) -> DataFrame:
    """One row per node: key (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256, and the node's name (x, y) and its parent's (ux, uy).

    `rebuild` makes the conversations and their turns from the numbered ones. Keys are
    integers. The result is computed.
    """
    spark = turns.sparkSession
    ensure_checkpoint_dir(spark)
    with ExitStack() as stack:
        folder = {n: stack.enter_context(passing(spark, f"trie-{n}")) for n in ("turns", "convs", "blocks", "classes", "alone", "nodes")}

        def kept(df: DataFrame, name: str) -> DataFrame:
            return written(df, f"trie-{name}", folder[name])

        convs, rebuilt = rebuild(positions(kept(numbered(turns, key, turn, role, text), "turns")))
        convs = kept(convs, "convs")
        blocks = kept(blocks_of(rebuilt), "blocks")
        grouped = blocks.groupBy("ex", "ey").agg(F.count("*").alias("n"), F.min("_c").alias("conv"), *[F.min(c).alias(c) for c in SAME])
        classes = kept(grouped, "classes")
        # a class without siblings is the whole of its group
        single = classes.groupBy("px", "py").agg(F.count("*").alias("_siblings"), *[F.min(c).alias(c) for c in classes.columns if c not in ("px", "py")])
        alone = kept(single.where("_siblings = 1").select(classes.columns), "alone")
        diverged = classes.join(alone.select("ex", "ey"), ["ex", "ey"], "left_anti")

        own = [[F.col("n").alias("n_convs")] * BLOCK, [F.col("conv")] * BLOCK]
        found = refined(alone, diverged, own, {"n_convs": F.sum("n_convs"), "conv": F.min("conv")})
        zero = F.lit(0).cast("long")
        none = F.lit(None).cast("long")
        top = convs.agg(F.count("*").alias("n_convs"), F.min("_c").alias("conv")).where("n_convs > 0")
        top = top.select(zero.alias("x"), zero.alias("y"), none.alias("ux"), none.alias("uy"), zero.alias("depth"), zero.alias("words"), zero.alias("before"), "n_convs", "conv")
        found = found.unionByName(top)
        children = found.where("ux IS NOT NULL").groupBy(F.col("ux").alias("x"), F.col("uy").alias("y")).agg(F.count("*").alias("n_children"))
        nodes = kept(found.join(children, ["x", "y"], "left").withColumn("n_children", F.coalesce("n_children", zero)), "nodes")

        # what a conversation does not own are the words before the first node it owns
        owners = nodes.groupBy(F.col("conv").alias("_c")).agg(F.min("before").alias("_others"), F.max(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("_leaf"))
        whole = blocks.groupBy("_c").agg(F.max(words_before(BLOCK + 1)).alias("_all"))
        facts = convs.join(owners, "_c", "left").join(whole, "_c", "left")
        facts = facts.select("_c", "_turns", F.coalesce("_others", "_all", zero).alias("_others"), F.coalesce("_leaf", F.lit(0)).alias("_leaf"))
        last = F.floor((F.col("_turns") - 1) / BLOCK)
        joined = blocks.join(in_pieces(facts, last + 1, CHUNK), ["_c", "_piece"])
        saved = [F.sum(F.greatest(F.col("_others") - words_before(k), zero)).alias(f"s{k}") for k in STEPS]
        sums = joined.groupBy("ex", "ey").agg(*saved, F.sum("_leaf").alias("leaves"))
        below = [[F.col(f"s{k}").alias("saved_tokens") for k in STEPS], [F.col("leaves").alias("n_leaves")] * BLOCK]
        totals = refined(alone.join(sums, ["ex", "ey"]), diverged.join(sums, ["ex", "ey"]), below, {n: F.sum(n) for n in ("saved_tokens", "n_leaves")})
        all_facts = facts.agg(F.sum("_others").alias("saved_tokens"), F.sum("_leaf").alias("n_leaves"))
        totals = totals.select("x", "y", "saved_tokens", "n_leaves").unionByName(all_facts.select(zero.alias("x"), zero.alias("y"), "saved_tokens", "n_leaves"))

        ending = joined.where(F.col("block") == last).select(F.col("ex").alias("x"), F.col("ey").alias("y"), "_c")
        ending = ending.unionByName(convs.where("_turns = 0").select(zero.alias("x"), zero.alias("y"), "_c"))
        table = nodes.join(totals, ["x", "y"]).join(ends_digest(ending), ["x", "y"], "left")

        parents = nodes.where("n_children > 0").select(F.col("x").alias("ux"), F.col("y").alias("uy"), F.col("conv").alias("parent_conv_id"), "n_children")
        # fewer than HOT rows: each has more than 1 / HOT of all nodes as children
        hot = F.broadcast(parents.where(F.col("n_children") > nodes.count() / HOT).drop("n_children"))
        near = table.join(hot, ["ux", "uy"])
        rest = table.join(hot.select("ux", "uy"), ["ux", "uy"], "left_anti").join(parents.drop("n_children"), ["ux", "uy"], "left")
        empty = F.lit(hashlib.sha256(b"").hexdigest())
        result = near.unionByName(rest).select(
            F.col("conv").alias(key), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", empty).alias("ends_sha256"), "x", "y", "ux", "uy",
        )
        with shuffles_removed(spark):
            return result.checkpoint()


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = prefix_trie(scan(spark, sf_dir, "conversations"), rebuild=shared_heads)
    return found.drop("x", "y", "ux", "uy")


ORACLE = r"""
WITH bits AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
  FROM range(256) AS r(i)
), own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                            md5(concat(length(coalesce(role, '')), ':', role, text))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, c - c % 20 AS base, n,
         xor(list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
                         lambda acc, b: xor(acc >> 8, t[(xor(acc, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) % 4 AS h
  FROM (SELECT c, count(*) AS n FROM own GROUP BY c), bits
), heads AS (
  SELECT v.c, v.h, v.n, (SELECT count(*) FROM own o WHERE o.c = v.base AND o.pos < v.h) AS take FROM convs v
), turns AS (
  SELECT v.c, o.pos, o.role, o.text FROM convs v JOIN own o ON o.c = v.base AND o.pos < v.h
  UNION ALL
  SELECT o.c, o.pos - h.h + h.take, o.role, o.text FROM own o JOIN heads h USING (c) WHERE o.pos >= h.h
), chained AS (
  SELECT c, pos + 1 AS depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         md5(string_agg(md5(concat(length(role), ':', role, text)), '') OVER (PARTITION BY c ORDER BY pos)) AS node
  FROM turns
), paths AS (
  SELECT c, depth, words, node, coalesce(lag(node) OVER (PARTITION BY c ORDER BY depth), '') AS up FROM chained
  UNION ALL
  SELECT c, 0, 0, '', NULL FROM convs
), nodes AS (
  SELECT depth, node, min(c) AS conv, count(*) AS n, any_value(words) AS words, any_value(up) AS up FROM paths GROUP BY depth, node
), children AS (
  SELECT depth - 1 AS depth, up AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), below AS (
  SELECT p.depth, p.node, sum((v.n - 1) * v.words)::BIGINT AS saved_tokens,
         count(*) FILTER (WHERE k.n_children IS NULL) AS n_leaves
  FROM nodes v JOIN paths p ON p.c = v.conv AND p.depth <= v.depth
  LEFT JOIN children k ON k.depth = v.depth AND k.node = v.node
  GROUP BY p.depth, p.node
), ends AS (
  SELECT depth, node, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends
  FROM (SELECT c, max(depth) AS depth, max_by(node, depth) AS node FROM paths GROUP BY c) GROUP BY depth, node
)
SELECT v.conv AS conv_id, v.depth::BIGINT AS depth, u.conv AS parent_conv_id, v.n::BIGINT AS n_convs,
       coalesce(k.n_children, 0)::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved_tokens,
       coalesce(e.ends, sha256('')) AS ends_sha256
FROM nodes v
LEFT JOIN nodes u ON u.depth = v.depth - 1 AND u.node = v.up
LEFT JOIN children k ON k.depth = v.depth AND k.node = v.node
LEFT JOIN below b ON b.depth = v.depth AND b.node = v.node
LEFT JOIN ends e ON e.depth = v.depth AND e.node = v.node
"""
