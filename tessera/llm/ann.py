"""Maximum inner product search with score-aware (anisotropic) quantisation.

Vectors are coded by 4 bits per subspace.  Training and coding weigh the part of the
residual that is parallel to the vector more than the rest, since only that part changes
high inner products.  A query's table of 16 products per subspace scores all codes; the
best are reranked by exact inner products.  Each row goes to one block with its code, and the
queries, of which there are fewer, pass by all blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import stored


@dataclass(frozen=True)
class AnnSpec:
    """k results per query; sample: vectors that fit the codebooks at most (all vectors are
    indexed); dims: dimensions per subspace; threshold: inner products of unit vectors
    from which errors matter; rerank: candidates per query and block of rows of which the
    exact products are taken; row_block: rows that one task scans.
    """

    k: int = 20
    sample: int = 16_384
    dims: int = 1
    threshold: float = 0.2
    rounds: int = 8
    rerank: int = 256
    row_block: int = 16_384
    seed: int = 11


def parallel_weight(dim: int, threshold: float) -> float:
    """How much more a parallel error costs than an orthogonal one, for uniformly spread queries."""
    t = threshold * threshold
    return max(1.0, (dim - 1) * t / (1 - t))


class Codebook:
    """16 centres per subspace; centres has shape (subspaces, 16, dims)."""

    def __init__(self, centres: np.ndarray, weight: float):
        self.centres, self.weight = centres, weight

    def split(self, x: np.ndarray) -> np.ndarray:
        m, _, d = self.centres.shape
        out = np.zeros((len(x), m * d))
        out[:, : x.shape[1]] = x
        return out.reshape(len(x), m, d)

    def encode(self, x: np.ndarray, sweeps: int = 2) -> np.ndarray:
        """Codes (n, subspaces) by coordinate descent on the anisotropic loss."""
        parts = self.split(x)
        unit = parts / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None, None]
        m = parts.shape[1]
        plain = ((parts[:, :, None, :] - self.centres[None]) ** 2).sum(-1)  # n, m, 16
        along = np.einsum("nmd,mcd->nmc", unit, self.centres)
        codes = plain.argmin(-1)
        rows = np.arange(len(x))
        norm = (parts * unit).sum((1, 2))
        total = np.take_along_axis(along, codes[:, :, None], 2)[:, :, 0].sum(1)
        for _ in range(sweeps):
            for j in range(m):
                rest = total - along[rows, j, codes[:, j]]
                error = norm[:, None] - rest[:, None] - along[:, j, :]
                codes[:, j] = (plain[:, j, :] + (self.weight - 1) * error**2).argmin(-1)
                total = rest + along[rows, j, codes[:, j]]
        return codes.astype(np.uint8)

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """(queries, subspaces, 16) products with the centres."""
        return np.einsum("qmd,mcd->qmc", self.split(queries), self.centres)


def train(x: np.ndarray, spec: AnnSpec) -> Codebook:
    """Alternates coding and solving each centre's least squares under the anisotropic loss."""
    dim = x.shape[1]
    m = -(-dim // spec.dims)
    weight = parallel_weight(dim, spec.threshold)
    rng = np.random.default_rng(spec.seed)
    padded = np.zeros((len(x), m * spec.dims))
    padded[:, :dim] = x
    start = padded.reshape(len(x), m, spec.dims)[rng.integers(0, len(x), 16)].transpose(1, 0, 2)
    book = Codebook(start + 1e-9 * rng.standard_normal(start.shape), weight)
    parts = book.split(x)
    unit = parts / np.linalg.norm(x, axis=1)[:, None, None]
    norm = (parts * unit).sum((1, 2))
    for step in range(spec.rounds):
        codes = Codebook(book.centres, 1.0 if step < spec.rounds // 2 else weight).encode(x, 1)
        w = (1.0 if step < spec.rounds // 2 else weight) - 1
        chosen = np.stack([book.centres[j][codes[:, j]] for j in range(m)], 1)
        along = (chosen * unit).sum(-1)
        total = along.sum(1)
        for j in range(m):
            rest = norm - (total - along[:, j])
            for c in range(16):
                mine = codes[:, j] == c
                n = int(mine.sum())
                if not n:
                    continue
                u = unit[mine, j]
                left = n * np.eye(spec.dims) + w * (u.T @ u)
                right = parts[mine, j].sum(0) + w * (rest[mine, None] * u).sum(0)
                book.centres[j, c] = np.linalg.solve(left, right)
            fresh = (book.centres[j][codes[:, j]] * unit[:, j]).sum(-1)
            total += fresh - along[:, j]
            along[:, j] = fresh
    return Codebook(book.centres, weight)


def pack_codes(codes: np.ndarray) -> np.ndarray:
    """Two codes per byte, the first in the low half; an odd last one stands alone."""
    if codes.shape[1] % 2:
        codes = np.hstack([codes, np.zeros((len(codes), 1), np.uint8)])
    return codes[:, ::2] | codes[:, 1::2] << 4


class Block:
    """Rows that queries pass by: ids ascending, codes by column, vectors as they are."""

    def __init__(self, ids: np.ndarray, packed: np.ndarray, vectors: np.ndarray):
        by = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.columns = ids[by], vectors[by], np.ascontiguousarray(packed[by].T)

    def scan(self, book: Codebook, queries: np.ndarray, own: np.ndarray, rerank: int, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, id, inner product) of each query's keep nearest but itself, ties to smaller ids.

        All codes are scored: the tables of two subspaces make one of 256 sums, looked up by a
        byte of the codes.  The rerank best of them are ranked by their exact products.
        """
        ids, vectors = self.ids, self.vectors
        tables = book.tables(queries).astype(np.float32)
        if tables.shape[1] % 2:
            tables = np.concatenate([tables, np.zeros((len(tables), 1, 16), np.float32)], 1)
        pairs = (tables[:, 1::2, :, None] + tables[:, ::2, None, :]).reshape(len(queries), -1, 256)
        out_q, out_id, out_score = [], [], []
        for q in range(len(queries)):
            scores = np.zeros(len(ids), np.float32)
            for j, column in enumerate(self.columns):
                scores += pairs[q, j].take(column)
            scores[ids == own[q]] = -np.inf
            k = min(rerank, len(ids))
            edge = np.partition(scores, len(ids) - k)[len(ids) - k]
            best = np.flatnonzero(scores > edge)
            best = np.concatenate([best, np.flatnonzero(scores == edge)[: k - len(best)]])
            best = np.sort(best[scores[best] > -np.inf])
            exact = np.zeros(len(best))
            for a, b in zip(np.ascontiguousarray(vectors[best].T), queries[q], strict=True):  # in the order of the components
                exact += a * b
            best, exact = (x[np.argsort(-exact, kind="stable")[:keep]] for x in (best, exact))
            out_q.append(np.full(len(best), q))
            out_id.append(ids[best])
            out_score.append(exact)
        return np.concatenate(out_q), np.concatenate(out_id), np.concatenate(out_score)


def valid_vectors(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """(id, v array<double>): vectors without null or non-finite components that are not zero.

    Of several lengths the most frequent takes part (of equally frequent ones the longest).
    """
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    df = vectors.select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<double>").alias("v"))
    df = df.where(F.col("id").isNotNull() & v.isNotNull()).where(~bad & F.exists(v, lambda x: x != 0))
    sizes = df.groupBy(F.size("v").alias("s")).agg(F.count("*").alias("c")).agg(F.max_by("s", F.struct("c", "s")).alias("s"))
    return df.where(F.size("v") == sizes.scalar())


def search(
    vectors: DataFrame, spec: AnnSpec = AnnSpec(), key: str = "vec_id", column: str = "embedding", is_query: Column | None = None
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest by inner product, of all other rows.

    is_query selects the queries (all rows where key % 20 = 0 by default).  Every row is
    coded and every code is scanned for every query: the work is queries times rows by nature.
    A row moves once, to its block; a task holds one block and streams the queries, which move
    once for each block.  The codebooks are fitted on the sample with the smallest hashes.
    score is the sum of the products in double precision, in the order of the components.

    Vectors that are null, zero, of another length than most, or hold null or non-finite
    components take no part, nor do rows with a null key.  Fewer other rows than k: all of
    them.  Ties go to the smaller key.  Rows with the same key are each a candidate, also
    for each other only where the keys differ; a repeated query key is one query with its
    first vector (in array order).  No rows give no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    asked = is_query if is_query is not None else F.col("id") % 20 == 0
    good = stored(valid_vectors(vectors, key, column))
    sample = good.orderBy(F.xxhash64(F.lit(spec.seed), "id"), "id").limit(spec.sample).toPandas()
    schema = "query_id long, rank int, vec_id long, score double"
    if sample.empty:
        return spark.createDataFrame([], schema)
    book = train(np.stack(sample["v"].to_numpy()), spec)
    dim = len(sample["v"].iloc[0])
    blocks = max(1, -(-good.count() // spec.row_block))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2_048):
                part = batch.slice(lo, 2_048)
                packed = pack_codes(book.encode(part.column("v").flatten().to_numpy().reshape(part.num_rows, dim)))
                yield pa.record_batch([*part.columns, pa.array([x.tobytes() for x in packed], pa.binary())], names=["rb", "id", "v", "code"])

    numbered = good.select(F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).cast("int").alias("rb"), "id", "v")
    rows = numbered.mapInArrow(encode, "rb int, id long, v array<double>, code binary").withColumn("query", F.lit(0))
    queries = good.where(asked).groupBy("id").agg(F.min("v").alias("v"))
    queries = queries.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("rb"), "id", "v", F.lit(None).cast("binary").alias("code"), F.lit(1).alias("query"))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, block = None, [], None
        for batch in batches:
            rb, kind = batch.column("rb").to_numpy(), batch.column("query").to_numpy()
            cuts = np.flatnonzero((rb[1:] != rb[:-1]) | (kind[1:] != kind[:-1])) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(rb)], strict=True):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                x = part.column("v").flatten().to_numpy().reshape(hi - lo, dim)
                if rb[lo] != number:
                    number, held, block = rb[lo], [], None
                if kind[lo] == 0:
                    codes = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(hi - lo, -1)
                    held.append((part.column("id").to_numpy(), codes, x))
                elif held or block is not None:
                    if block is None:
                        block, held = Block(*map(np.concatenate, zip(*held, strict=True))), []
                    own = part.column("id").to_numpy()
                    for at in range(0, len(own), 256):  # some queries' tables at a time
                        q, vec, score = block.scan(book, x[at : at + 256], own[at : at + 256], spec.rerank, spec.k)
                        yield pa.record_batch([pa.array(own[at + q]), pa.array(vec), pa.array(score)], names=["query_id", "vec_id", "score"])

    both = rows.unionByName(queries).repartition("rb").sortWithinPartitions("rb", "query")
    found = both.mapInArrow(best, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= spec.k)
    return ranked.select("query_id", "rank", "vec_id", "score")
