"""Nearest neighbours by a block matrix join (operator 7): exact, by inner product.

Vectors are packed into blocks by a hash of their id, a row per block, kept as 8-bit
integers with a scale and as the original values. Every pair of a query block and a
candidate block is one task's group: the product of the integer matrices gives
approximate inner products, and the norms of the rounding errors bound how far off they
are. A candidate whose upper bound is below the k-th best lower bound of its query is
dropped; the others are computed anew in double precision, term by term in the order of
the components, so equal vectors get equal scores. Heaps keep the best k of each query
over the tiles of a block; blocks are merged by a window on the query, of which Spark
keeps k rows per partition before the shuffle.

The queries are a stated set, met with all rows in blocks of bounded size.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components
take no part, nor do rows with a null id; vectors meet only those of equal length; of rows
that repeat an id and a vector, each counts as a candidate of other ids; ties go to the
smaller id, then to either row. With fewer candidates than k, all are returned.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegrid.llm.common import scan

K = 20
QUERY_BLOCK = 4096
ROW_BLOCK = 16384
TILE = 2048


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """_id, _vec (doubles), _dim of the vectors that take part."""
    rows = vectors.select(F.col(key).cast("long").alias("_id"), F.col(vector).cast("array<double>").alias("_vec"))
    finite = F.forall("_vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists("_vec", lambda x: x != 0)
    return rows.where(F.col("_id").isNotNull() & (F.size("_vec") > 0) & finite & nonzero).withColumn("_dim", F.size("_vec"))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """8-bit integers, scales, and the norms of what rounding took away."""
    scale = np.abs(x).max(1) / 127
    scale[scale == 0] = 1.0
    q = np.rint(x / scale[:, None]).astype(np.int8)
    return q, scale, np.sqrt(((x - q * scale[:, None]) ** 2).sum(1))


def integer_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of 8-bit integers, exact: sums of 1,024 products fit a 32-bit float."""
    out = np.zeros((len(a), len(b)), np.float64)
    for at in range(0, a.shape[1], 1024):
        out += a[:, at : at + 1024].astype(np.float32) @ b[:, at : at + 1024].astype(np.float32).T
    return out


def exact_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of row pairs, added up in the order of the components."""
    out = np.zeros(len(x))
    for j in range(x.shape[1]):
        out += x[:, j] * y[:, j]
    return out


def block_best(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query, candidate, score): each query's best k of this block's candidates."""
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], c[order]
    q8, q_scale, q_off = quantised(q)
    q_norm = np.sqrt((q**2).sum(1))
    heaps: list[list[tuple[float, int]]] = [[] for _ in q_ids]
    # each query meets its own id at most once per row of that id; those are left out below
    for at in range(0, len(c_ids), TILE):
        ids, part = c_ids[at : at + TILE], c[at : at + TILE]
        c8, c_scale, c_off = quantised(part)
        c_near = np.sqrt(((c8 * c_scale[:, None]) ** 2).sum(1))
        near = integer_products(q8, c8) * q_scale[:, None] * c_scale[None, :]
        # <x, y> - <x', y'> = <x, y - y'> + <x - x', y'>
        off = q_norm[:, None] * c_off[None, :] + q_off[:, None] * c_near[None, :]
        off += 1e-12 * (1 + q_norm[:, None] * c_near[None, :])
        own = q_ids[:, None] == ids[None, :]
        low = np.where(own, -np.inf, near - off)
        floor = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps])
        if low.shape[1] > k:
            floor = np.maximum(floor, np.partition(low, -k, axis=1)[:, -k])
        rows, cols = np.nonzero((near + off >= floor[:, None]) & ~own)
        scores = exact_products(q[rows], part[cols])
        for r, score, name in zip(rows.tolist(), scores.tolist(), (-ids[cols]).tolist()):
            heap = heaps[r]
            if len(heap) < k:
                heapq.heappush(heap, (score, name))
            elif heap[0] < (score, name):
                heapq.heapreplace(heap, (score, name))
    return [(int(name), -other, score) for name, heap in zip(q_ids, heaps) for score, other in heap]


def packed(rows: DataFrame, blocks: int) -> DataFrame:
    """_block, _dim, ids, values: blocks of bounded size, each in one row."""

    def pack(group: pa.Table) -> pa.Table:
        values = group["_vec"].combine_chunks()
        flat = values.flatten() if isinstance(values, pa.ListArray) else pa.concat_arrays([v.flatten() for v in values.chunks])
        return pa.table(
            {
                "_block": [group["_block"][0].as_py()],
                "_dim": [group["_dim"][0].as_py()],
                "ids": [group["_id"].to_numpy().astype("<i8").tobytes()],
                "vals": [flat.to_numpy().astype("<f8").tobytes()],
            },
            schema=pa.schema([("_block", pa.int32()), ("_dim", pa.int32()), ("ids", pa.binary()), ("vals", pa.binary())]),
        )

    placed = rows.withColumn("_block", F.pmod(F.xxhash64("_id", "_vec"), F.lit(blocks)).cast("int"))
    return placed.groupBy("_block", "_dim").applyInArrow(pack, "_block int, _dim int, ids binary, vals binary")


def neighbours(vectors: DataFrame, is_query, key: str, vector: str, k: int = K) -> DataFrame:
    """query_id, rank, <key>, score."""
    rows = usable(vectors, key, vector)
    asked = rows.where(is_query(F.col("_id")))
    n_rows, n_asked = rows.count(), asked.count()
    row_blocks, query_blocks = max(1, -(-n_rows // ROW_BLOCK)), max(1, -(-n_asked // QUERY_BLOCK))
    names = ["_block", "_dim", "ids", "vals"]
    queries = packed(asked.distinct(), query_blocks).select(F.struct(*names[1:]).alias("q"), F.col("_block").alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("cb"))
    queries = queries.select("qb", "cb", F.col("q._dim").alias("_dim"), F.col("q.ids").alias("q_ids"), F.col("q.vals").alias("q_vals"))
    candidates = packed(rows, row_blocks).select(F.col("_block").alias("cb"), "_dim", F.col("ids").alias("c_ids"), F.col("vals").alias("c_vals"))
    pairs = queries.join(candidates, ["cb", "_dim"])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["_dim"]
                q_ids, c_ids = (np.frombuffer(row[c], "<i8") for c in ("q_ids", "c_ids"))
                q, c = (np.frombuffer(row[v], "<f8").reshape(-1, dim) for v in ("q_vals", "c_vals"))
                for at in range(0, len(q_ids), 512):
                    found = block_best(q_ids[at : at + 512], q[at : at + 512], c_ids, c, k)
                    if found:
                        arrays = [pa.array(col, t) for col, t in zip(zip(*found), (pa.int64(), pa.int64(), pa.float64()))]
                        yield pa.RecordBatch.from_arrays(arrays, ["query_id", key, "score"])

    found = pairs.select("_dim", "q_ids", "q_vals", "c_ids", "c_vals").mapInArrow(best, f"query_id long, `{key}` long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), key)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", key, "score")


def op7_block_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(scan(spark, sf_dir, "embeddings"), lambda name: name % 20 == 0, "vec_id", "embedding")


ORACLE = f"""
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_reduce(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i]), lambda a, b: a + b) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= {K}
"""
