"""Approximate nearest neighbours by inner product from randomly rotated one-bit codes.

A vector is turned by a random rotation and kept as one sign bit per dimension, with two scalars. From the bits and a turned query
follow an estimate of the inner product and a bound of its error. Each query's best estimates are
computed exactly; then every vector whose upper bound reaches the k-th best of those is. The search goes by cells, a
block of queries against a block of vectors, so that no task holds all of either.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerwright.session import materialize


@lru_cache(maxsize=4)
def rotation(size: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same wherever it is drawn."""
    q, r = np.linalg.qr(np.random.default_rng([seed, size]).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed bits, the factor that makes bits an estimate, and the error per length of a query and unit of the bound."""
    size = vectors.shape[1]
    norms = np.linalg.norm(vectors, axis=1)
    turned = (vectors / norms[:, None]) @ rotation(size, seed).T
    agree = np.abs(turned).sum(axis=1) / np.sqrt(size)  # inner product of the unit vector and its code
    error = norms * np.sqrt(np.maximum(0.0, 1 - agree * agree)) / agree / np.sqrt(max(1, size - 1))
    return np.packbits(turned > 0, axis=1), norms / agree, error


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    """A column of lists of one length as a matrix of doubles."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def with_codes(vectors: DataFrame, seed: int) -> DataFrame:
    """``id, vec, size`` with ``code, factor, error``. Every row is indexed."""

    def run(batches):
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            n = batch.num_rows
            codes, factor, error = [b""] * n, np.zeros(n), np.zeros(n)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                bits, factor[at], error[at] = encode(_matrix(batch.column("vec").take(pa.array(at)), int(size)), seed)
                for i, row in zip(at, bits, strict=True):
                    codes[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(codes, pa.binary()), pa.array(factor), pa.array(error)],
                names=[*batch.schema.names, "code", "factor", "error"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema.fields)
    return vectors.mapInArrow(run, f"{kinds}, code binary, factor double, error double")


def _top(query: np.ndarray, ident: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best, ties to the smaller id."""
    order = np.lexsort((ident, -score, query))
    q = query[order]
    first = np.r_[True, q[1:] != q[:-1]]
    start = np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
    return order[np.arange(len(q)) - start < k]


def search_cell(ids: np.ndarray, vecs: np.ndarray, codes: np.ndarray, factor: np.ndarray, error: np.ndarray,
                query_ids: np.ndarray, queries: np.ndarray, k: int, seed: int, bound: float,
                block: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of a block of vectors for each query, as (place of the query, id, exact inner product).

    ``bound`` is the number of standard errors that an estimate is trusted within.
    """
    size = vecs.shape[1]
    signs = np.unpackbits(codes, axis=1, count=size).astype(np.float32) * 2 - 1
    lengths = np.linalg.norm(queries, axis=1)
    turned = ((queries / lengths[:, None]) @ rotation(size, seed).T / np.sqrt(size)).astype(np.float32)
    # Estimates are for queries of length one; the last term covers single precision.
    scale = factor.astype(np.float32)
    slack = (bound * error + 1e-5 * factor).astype(np.float32)
    by_id = np.argsort(ids, kind="stable")
    own = [by_id[a:b] for a, b in zip(np.searchsorted(ids, query_ids, sorter=by_id),
                                      np.searchsorted(ids, query_ids, "right", sorter=by_id), strict=True)]
    n = min(4 * k, len(ids))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
        out = np.empty(len(q))
        for at in range(0, len(q), 4_096):
            part = slice(at, at + 4_096)
            out[part] = (vecs[c[part]] * queries[q[part]]).sum(axis=1)
        return out

    for first in range(0, len(queries), block):
        some = np.arange(first, min(first + block, len(queries)))
        estimate = turned[some] @ signs.T
        estimate *= scale
        for i in some:
            estimate[i - first, own[i]] = -np.inf
        best = np.argpartition(estimate, len(ids) - n, axis=1)[:, len(ids) - n:]
        score = exact(np.repeat(some, n), best.ravel()).reshape(len(some), n)
        score[np.isneginf(np.take_along_axis(estimate, best, axis=1))] = -np.inf
        reach = np.sort(score, axis=1)[:, -k] / lengths[some] if n >= k else np.full(len(some), -np.inf)
        estimate += slack
        q, c = np.nonzero((estimate >= reach[:, None]) & ~np.isneginf(estimate))
        score = exact(some[q], c)
        keep = _top(q, ids[c], score, k)
        found.append((some[q[keep]], ids[c[keep]], score[keep]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def takes_part(vector: Column) -> Column:
    """Neither null nor empty nor zero, and all components finite."""
    infinite = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < infinite), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", *, k: int = 20, seed: int = 1,
            bound: float = 3.0, cell_vectors: int = 32_768, cell_queries: int = 2_048) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``rows`` that ``is_query`` picks, the ``k`` nearest other rows.

    ``is_query`` is a condition on the id column. Nearness is the inner product in double precision of the original vectors; ties go
    to the smaller id. Null, empty and zero vectors, vectors with null or non-finite components and rows without id take no part;
    neither do vectors of another length than the query's. A repeated (id, vector) counts once; rows with
    the query's id are no candidates of it. Fewer than ``k`` candidates give all of them; no rows give none.

    Equal vectors tie, so of each the ``k + 1`` smallest ids suffice (one may be the query's own); with more ids
    no other could come into a result. Only these are searched. An estimate's error is as good as normal: with ``bound = 3`` standard errors one in seven
    hundred of those whose estimate is at the limit is lost, which is far fewer of all; tests compare with brute force at every given size.
    """
    all_rows = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vec"),
                           is_query.alias("asks"))
    valid = all_rows.filter(F.col("id").isNotNull() & takes_part(F.col("vec"))).withColumn("size", F.size("vec"))
    # -0.0 and 0.0 are one value in a key, so equal keys are equal vectors.
    by_vector = Window.partitionBy("vec").orderBy("id")
    indexed = (valid.select("id", "vec", "size").distinct().withColumn("nth", F.row_number().over(by_vector))
               .filter(F.col("nth") <= k + 1).drop("nth"))
    indexed = materialize(with_codes(indexed, seed), "codes")
    queries = materialize(valid.filter("asks").select("id", "vec", "size").distinct(), "queries")
    n_cells = max(1, -(-indexed.count() // cell_vectors))
    n_blocks = max(1, -(-queries.count() // cell_queries))

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        size = key[0].as_py()
        if left.num_rows and right.num_rows:
            codes = np.frombuffer(b"".join(left.column("code").to_pylist()), np.uint8).reshape(left.num_rows, -1)
            asks = right.column("id").to_numpy()
            q, ids, score = search_cell(left.column("id").to_numpy(), _matrix(left.column("vec"), size), codes,
                                        left.column("factor").to_numpy(), left.column("error").to_numpy(), asks,
                                        _matrix(right.column("vec"), size), k, seed, bound)
            found = [asks[q], ids, score]
        else:
            found = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        return pa.table(found, names=["query_id", "vec_id", "score"])

    def cell(column: str, n: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")

    left = indexed.withColumn("cell", cell("id", n_cells)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    right = queries.withColumn("block", cell("id", n_blocks)).withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(n_cells - 1))))
    keys = ["size", "cell", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
    # A query id with several vectors, or a candidate with several, may come more than once: its best counts.
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
