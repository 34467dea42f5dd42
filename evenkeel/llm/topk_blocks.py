"""Exact top-k inner products by block-at-a-time pruning.

Rows are laid in blocks of a document range. A block keeps the largest and smallest value of every term
(component); a query's bound for it is the sum of the larger products. Blocks are scored through their
forward index, the matrix of their rows, in order of bounds, until the bound falls below the k-th score.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 64
RANGE = 1024  # consecutive rows that go to a shard together
SHARD_ROWS = 8192
QUERY_ROWS = 2048
EXACT = float(1 << 53)


def quantised(vectors: DataFrame, is_query: Column, scale: int = 256) -> DataFrame:
    """``vec_id, row, q, v``: floor(scale * x) of each component as 64-bit integers, of complete vectors only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, rows = [], []
            for i, x in enumerate(batch["embedding"]):
                values = None if not x.is_valid or x.values.null_count else x.values.to_numpy(
                    zero_copy_only=False).astype(np.float64)
                if values is not None and np.isfinite(values).all():
                    keep.append(i)
                    rows.append(np.floor(scale * values).astype(np.int64).tobytes())
            kept = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [kept["vec_id"], kept["row"], kept["q"], pa.array(rows, pa.binary())], ["vec_id", "row", "q", "v"])

    return (vectors.filter(F.col("vec_id").isNotNull())
            .select("vec_id", F.monotonically_increasing_id().alias("row"),
                    F.coalesce(is_query, F.lit(False)).alias("q"), "embedding")
            .mapInArrow(run, "vec_id bigint, row bigint, q boolean, v binary"))


def _matrix(blobs, width: int) -> np.ndarray:
    """Rows as float64 where products of them are exact in it; shorter vectors end in zeros."""
    out = np.zeros((len(blobs), width), np.int64)
    for i, b in enumerate(blobs):
        out[i, :len(b) // 8] = np.frombuffer(b, np.int64)
    return out


def search_shard(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best rows of a shard for each query."""
    width = max(max(map(len, queries["v"])), max(map(len, rows["v"]))) // 8
    rows = rows.sort_values(["vec_id", "row"])
    ids = rows["vec_id"].to_numpy()
    forward, asked = _matrix(rows["v"], width), _matrix(queries["v"], width)
    if width * float(np.abs(forward).max(initial=0)) * float(np.abs(asked).max(initial=0)) < EXACT:
        forward, asked = forward.astype(np.float64), asked.astype(np.float64)
    starts = np.arange(0, len(ids), BLOCK)
    high, low = np.maximum.reduceat(forward, starts), np.minimum.reduceat(forward, starts)
    bounds = np.maximum(asked, 0) @ high.T + np.minimum(asked, 0) @ low.T
    out = []
    for i, own in enumerate(queries["vec_id"].to_numpy()):
        order = np.argsort(-bounds[i], kind="stable")
        best_ids, best, at, step = ids[:0], asked[0, :0], 0, 2
        while at < len(order):
            if len(best) >= k and bounds[i, order[at]] < best[k - 1]:
                break
            inside = (order[at:at + step, None] * BLOCK + np.arange(BLOCK)).reshape(-1)
            inside = inside[inside < len(ids)]
            inside = inside[ids[inside] != own]
            best_ids = np.concatenate([best_ids, ids[inside]])
            best = np.concatenate([best, forward[inside] @ asked[i]])
            top = np.lexsort((best_ids, -best))[:k]
            best_ids, best, at, step = best_ids[top], best[top], at + step, step * 2
        out.append((best_ids, best))
    sizes = [len(b) for _, b in out]
    return pd.DataFrame({
        "query_row": np.repeat(queries["row"].to_numpy(), sizes), "query_id": np.repeat(queries["vec_id"].to_numpy(), sizes),
        "vec_id": np.concatenate([x for x, _ in out]), "score": np.concatenate([x for _, x in out]).astype(np.int64)})


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query row's k highest inner products, ties to smaller ids.

    Null vectors, null ids and vectors with a null or non-finite component take no part. A row with the
    query's id is not its candidate; repeated rows count as often as they come, as queries and as candidates.
    Vectors of different length are compared as if the shorter ended in zeros. Scores must fit in a BIGINT.
    Rows are dealt to shards by runs and query rows to groups; each pair of the two is searched by itself.
    """
    clean = quantised(vectors, is_query, scale)
    size = clean.agg(F.count(F.lit(1)).alias("n"), F.count_if("q").alias("q")).first()
    shards, groups = -(-size["n"] // SHARD_ROWS) or 1, -(-size["q"] // QUERY_ROWS) or 1

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    asked = clean.filter("q").select(
        "vec_id", "row", "v", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("chunk"),
        every(shards).alias("shard"))
    stored = clean.select(
        "vec_id", "row", "v", every(groups).alias("chunk"),
        F.pmod(F.xxhash64(F.expr(f"row div {RANGE}")), F.lit(shards)).cast("int").alias("shard"))

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_row", "query_id", "vec_id", "score")})
        return search_shard(queries, rows, k)

    found = asked.groupBy("chunk", "shard").cogroup(stored.groupBy("chunk", "shard")).applyInPandas(
        run, "query_row bigint, query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
