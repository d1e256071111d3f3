"""Exact top-k search by a Voronoi kNN join on integer inner products.

Pivots, a bounded sample of distinct vectors, split the data into cells. A cell's summary is its count and the largest
distance of a member to its pivot. A query's score on any member lies within |query| * radius of its score on the
pivot, so summaries alone give a score that k members surely reach, and only cells whose upper bound reaches it are
searched. Cells are cut into blocks, queries into chunks of neighbouring cells: a task holds one block and one chunk,
whatever the skew, and a block is sent to a chunk only where one of its queries asked for it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postalis.llm.common import durable, map_arrow

#: Integers that doubles, and 64-bit integers, hold exactly.
SAFE, WORD = float(1 << 53), float(1 << 63)


def quantise(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """(vec_id, dim, v): floor(scale * x) as little-endian doubles, which are exact whole numbers; null, empty or
    non-finite vectors are left out."""

    def make():
        def step(batch: pa.RecordBatch):
            ids, dims, out = [], [], []
            for key, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key is None or not vector or None in vector:
                    continue
                x = np.asarray(vector, np.float64)
                if np.isfinite(x).all():
                    v = np.floor(scale * x)
                    if not np.isfinite(v).all():
                        raise OverflowError(f"vector {key}: {scale} times a component is no double")
                    ids.append(key)
                    dims.append(len(v))
                    out.append(v.astype("<f8").tobytes())
            yield {"vec_id": ids, "dim": dims, "v": out}

        return step

    return map_arrow(vectors.select(F.col(id_column).cast("long"), vector_column), make, "vec_id long, dim int, v binary")


def matrix(values) -> np.ndarray:
    return np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1) if len(values) else np.zeros((0, 0))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: BLAS in doubles where every sum stays below 2**53, 64-bit integers below 2**63, else
    Python's integers."""
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] if a.size and b.size else 0.0
    if most < SAFE:
        return (a @ b.T).astype(np.int64)
    if most < WORD / 2:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = np.frompyfunc(int, 1, 1)
    return whole(a).astype(object) @ whole(b).astype(object).T


def longs(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object and any(not -(1 << 63) <= x < 1 << 63 for x in scores):
        raise OverflowError("a score is beyond 64 bits")
    return scores.astype(np.int64)


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, id_column: str = "vec_id", vector_column: str = "embedding", most_pivots: int = 1024, block: int = 4096, chunk: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best other rows, ties to the smaller vec_id.

    is_query is a condition on vec_id. Only vectors of the same length are compared. A row with a null id or a vector
    that is null, empty or holds null or non-finite parts takes no part. A repeated id is a row of its own: a query
    leaves out itself alone. Fewer than k other rows give all of them. Other columns, whatever their names, are left
    aside; an empty table gives an empty result. Components may be of any size: sums are exact, and a score among the
    results that 64 bits don't hold, or a scaled component that no double holds, is an error. Pivots: min(most_pivots,
    about sqrt(rows)) from a sample; the result doesn't depend on them.
    """
    spark = vectors.sparkSession
    data = durable(quantise(vectors, id_column, vector_column, scale).withColumn("uid", F.monotonically_increasing_id()))
    rows = data.count()
    n_pivots = int(min(most_pivots, max(4, rows**0.5 / 4)))
    part = F.pmod(F.xxhash64(F.lit("pivot"), "uid"), F.lit(1 << 30)) / float(1 << 30)
    drawn = data.filter(part < 4 * n_pivots / max(rows, 1)).select("dim", "v").limit(8 * n_pivots).collect()
    picked = list(dict.fromkeys((r.dim, bytes(r.v)) for r in drawn))[:n_pivots]
    by_dim = {dim: matrix([v for d, v in picked if d == dim]) for dim in {d for d, _ in picked}}
    pivots = spark.sparkContext.broadcast(by_dim)  # most_pivots vectors at most

    def celled():
        def step(batch: pa.RecordBatch):
            dims, values = batch.column(1).to_numpy(), batch.column(2).to_pylist()
            cell, far = np.full(len(dims), -1, np.int64), np.zeros(len(dims))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                if (p := pivots.value.get(int(dim))) is not None:
                    x = matrix([values[i] for i in at])
                    square = np.maximum((x * x).sum(1)[:, None] - 2 * (x @ p.T) + (p * p).sum(1), 0)
                    cell[at] = square.argmin(1)
                    far[at] = np.linalg.norm(x - p[cell[at]], axis=1)
            yield {"vec_id": batch.column(0), "dim": batch.column(1), "v": batch.column(2), "uid": batch.column(3), "cell": cell, "far": far}

        return step

    cells = durable(map_arrow(data, celled, "vec_id long, dim int, v binary, uid long, cell long, far double"))
    summary = {}
    for r in cells.groupBy("dim", "cell").agg(F.count("*"), F.max("far")).collect():  # a row per pivot, and per length of vector that has none
        summary.setdefault(r[0], []).append((r[1], r[2], r[3]))
    summaries = spark.sparkContext.broadcast({d: np.array(sorted(rows)) for d, rows in summary.items()})

    def routed():
        def step(batch: pa.RecordBatch):
            names = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            dims, values = names["dim"].to_numpy(), names["v"].to_pylist()
            rows, cell, blocks = [], [], []
            for dim in np.unique(dims):
                at, table = np.flatnonzero(dims == dim), summaries.value[int(dim)]
                number = table[:, 0].astype(int)
                x = matrix([values[i] for i in at])
                norm = np.linalg.norm(x, axis=1)[:, None]
                p = pivots.value.get(int(dim))
                p = np.zeros((len(table), int(dim))) if p is None else p[np.maximum(number, 0)]
                mid = x @ p.T
                slack = norm * table[:, 2] + 1e-9 * (1 + norm * (np.linalg.norm(p, axis=1) + table[:, 2]))  # and what rounding may take
                slack = np.where((number >= 0) & np.isfinite(mid) & np.isfinite(slack), slack, np.inf)
                mid = np.where(np.isfinite(mid), mid, 0.0)
                low, high = mid - slack, mid + slack
                order = np.argsort(-low, axis=1)
                held = np.cumsum(table[:, 1][order], axis=1) > k  # one of them may be the query itself
                sure = np.where(held.any(1), np.take_along_axis(low, np.take_along_axis(order, held.argmax(1)[:, None], 1), 1)[:, 0], -np.inf)
                q, c = np.nonzero(high >= sure[:, None])
                rows.append(at[q])
                cell.append(number[c])
                blocks.append(-(-table[c, 1].astype(int) // block))
            rows, cell, blocks = (np.concatenate(x) if x else np.zeros(0, int) for x in (rows, cell, blocks))
            take = np.repeat(rows, blocks)
            first = np.repeat(np.cumsum(blocks) - blocks, blocks)
            picks = pa.array(take)
            yield {"vec_id": names["vec_id"].take(picks), "dim": names["dim"].take(picks), "v": names["v"].take(picks), "uid": names["uid"].take(picks), "part": names["part"].take(picks), "cell": np.repeat(cell, blocks), "blk": np.arange(len(take)) - first}

        return step

    queries = cells.filter(is_query)
    dealt, seen = [], 0  # queries of a cell to its chunks, or of several small cells to one
    for r in queries.groupBy("dim", "cell").agg(F.count("*").alias("n")).orderBy("dim", "cell").collect():  # a row per cell
        dealt.append((r.dim, r.cell, seen // chunk, -(-r.n // chunk)))
        seen += r.n
    dealt = F.broadcast(spark.createDataFrame(dealt, "dim int, cell long, _first long, _n long"))  # a row per cell
    parted = queries.join(dealt, ["dim", "cell"]).withColumn("part", F.col("_first") + F.pmod(F.xxhash64("uid"), F.col("_n")))
    asked = durable(map_arrow(parted.select("vec_id", "dim", "v", "uid", "part"), routed, "vec_id long, dim int, v binary, uid long, part long, cell long, blk long"))
    counts = {(d, int(r[0])): int(r[1]) for d, rows in summaries.value.items() for r in rows}
    sizes = spark.createDataFrame([(d, c, -(-n // block)) for (d, c), n in counts.items()], "dim int, cell long, blocks long")
    placed = cells.join(F.broadcast(sizes), ["dim", "cell"]).withColumn("blk", F.pmod(F.xxhash64("uid", F.lit(7)), "blocks"))  # a row per cell
    wanted = asked.select("dim", "cell", "blk", F.col("part").alias("to")).distinct().withColumnRenamed("to", "part")
    held = placed.join(wanted, ["dim", "cell", "blk"]).select("vec_id", "dim", "v", "uid", "cell", "blk", "part")

    def solved(ask: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        if not len(ask) or not len(have):
            return pd.DataFrame({"uid": [], "query_id": [], "vec_id": [], "score": []})
        have = have.sort_values("vec_id", kind="stable")
        score = products(matrix(ask["v"].tolist()), matrix(have["v"].tolist()))
        own = ask["uid"].to_numpy()[:, None] == have["uid"].to_numpy()
        ids = have["vec_id"].to_numpy()
        q, c = [], []
        for i in range(len(ask)):
            line, at = score[i], np.flatnonzero(~own[i])
            if len(at) > k:
                bound = np.sort(line[at])[-k] if line.dtype == object else np.partition(line[at], len(at) - k)[len(at) - k]
                at = at[line[at] >= bound]
            order = sorted(range(len(at)), key=lambda j: (-line[at[j]], ids[at[j]])) if line.dtype == object else np.lexsort((ids[at], -line[at]))
            at = at[order[:k]]
            q.append(np.full(len(at), i))
            c.append(at)
        q, c = np.concatenate(q), np.concatenate(c)
        return pd.DataFrame({"uid": ask["uid"].to_numpy()[q], "query_id": ask["vec_id"].to_numpy()[q], "vec_id": ids[c], "score": longs(score[q, c])})

    keys = ["dim", "cell", "blk", "part"]
    near = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(solved, "uid long, query_id long, vec_id long, score long")
    best = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
