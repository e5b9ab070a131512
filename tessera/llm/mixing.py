"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source is dealt by hash into blocks in random order.  The mix takes an exact number
of blocks of each source (whole passes, then the first blocks of one more pass, the last
cut at a word).  A binary tree over the output shards splits these quotas: at each node a
multivariate hypergeometric draw says how many blocks of each source go left.  A block's
shard follows from its number and its source's path down the tree, so the documents are
only scanned; the tree is small and the same for all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import SPACE_CLASS, WORD_PATTERN, stored, word_count

WEIGHTS = (5.0, 2.0, 1.0)


@dataclass(frozen=True)
class MixSpec:
    """weights repeat over the sources in code point order, null last; share: words of the
    mix over words of the input; most: no source gets more than this times its size (2 at
    most, so that no document is taken more than twice); blocks: a source's blocks per
    pass; shards: output shards, a power of two; max_sources: the sources whose quotas the
    driver holds, more is an error.
    """

    weights: tuple[float, ...] = WEIGHTS
    share: float = 1.5
    most: float = 2.0
    blocks: int = 1024
    shards: int = 16
    seed: int = 7
    max_sources: int = 200_000


def targets(sizes: list[int], spec: MixSpec) -> list[float]:
    """Target words of each source: share of all words by weight; what is above a source's
    limit is shared anew by weight among the others until none is above.
    """
    size = np.asarray(sizes, dtype=float)
    weight = np.resize(np.asarray(spec.weights, dtype=float), len(size))
    limit, target = spec.most * size, np.zeros(len(size))
    total, free = spec.share * size.sum(), np.ones(len(size), bool)
    if total >= limit.sum():
        return limit.tolist()
    while free.any():
        rest = total - limit[~free].sum()
        target[free] = rest * weight[free] / weight[free].sum()
        over = free & (target > limit)
        if not over.any():
            break
        target[over] = limit[over]
        free &= ~over
    return target.tolist()


def splitting_tree(counts: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """For each source the left child's blocks at each node, as a heap (node 1 is the root).

    Every node's draw has its own seed, so the tree does not depend on the order of work.
    Draws without replacement: the leaves' quotas add up to the counts exactly.
    """
    left = np.zeros((len(counts), max(shards, 1)), dtype=np.int64)
    have = {1: np.asarray(counts, dtype=np.int64)}
    for node in range(1, shards):
        mine = have.pop(node)
        rng = np.random.default_rng([seed, node])
        got = rng.multivariate_hypergeometric(mine, int(mine.sum()) // 2, method="marginals") if mine.sum() else mine
        left[:, node] = got
        have[2 * node], have[2 * node + 1] = got, mine - got
    return left


def _row_hash(keys: list[str], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])


def sized(docs: DataFrame, spec: MixSpec, text: str, source: str, key: str) -> DataFrame:
    """docs with __source, size, __hash (the document's place in the source's random order)."""
    df = docs.withColumns({"__source": F.col(source).cast("string"), "size": word_count(F.col(text)), "__text_hash": F.xxhash64(text)})
    return df.withColumn("__hash", _row_hash([key, "__text_hash"], spec.seed)).drop("__text_hash")


def __block(spec: MixSpec) -> Column:
    return F.pmod(F.col("__hash"), F.lit(spec.blocks))


def __part(spec: MixSpec) -> Column:
    """The part of its block that a document is in; blocks are in the order of their parts, parts in that of the hash."""
    return F.pmod(F.floor(F.col("__hash") / F.lit(spec.blocks)), F.lit(spec.blocks)).cast("long")


def _reached(sums: DataFrame, step: str, least: str) -> DataFrame:
    """The row of each source at which the cumulative sum of w in the order of step passes least.

    sums has a row per source and step, at most as many as a source has blocks but for the last look.
    """
    run = W.partitionBy("__i").orderBy(step).rowsBetween(W.unboundedPreceding, 0)
    upto = sums.withColumn("__sum", F.sum("w").over(run)).where((F.col("__sum") > F.col(least)) & (F.col("__sum") - F.col("w") <= F.col(least)))
    return upto.withColumn("__rest", F.col(least) - F.col("__sum") + F.col("w"))


def plan_sources(slim: DataFrame, spec: MixSpec) -> DataFrame:
    """One row per source: its quota, where its last block is cut, and its path counts.

    slim: (__source, __hash, size).  The documents of one part of one block per source are
    ordered, a millionth of it by default; sums are pre-aggregated before the shuffle.
    """
    spark = slim.sparkSession
    sums = slim.groupBy("__source").agg(F.sum("size").alias("size")).limit(spec.max_sources + 1).collect()
    if len(sums) > spec.max_sources:
        raise ValueError(f"more than {spec.max_sources} sources; raise max_sources if the driver can hold them")
    sums.sort(key=lambda r: (r["__source"] is None, (r["__source"] or "").encode()))
    goal = targets([r["size"] for r in sums], spec)
    rows = []
    for i, (r, t) in enumerate(zip(sums, goal, strict=True)):
        take, size = round(t), r["size"]
        passes = min(take // size, int(spec.most)) if size else 0
        rows.append((i, r["__source"], size, float(t), int(passes), int(take - passes * size)))
    source_rows = spark.createDataFrame(rows, "__i int, __source string, source_size long, target double, __passes int, __part long")
    by_source = slim.join(_small(source_rows, len(rows)), slim["__source"].eqNullSafe(source_rows["__source"])).drop("__source")
    # the block in which the last pass ends, its part, and the document there: each a sum over what the look before found
    blocks = by_source.where("__part > 0").withColumn("__block", __block(spec)).groupBy("__i", "__part", "__block").agg(F.sum("size").alias("w"))
    last = {r["__i"]: (r["__block"], r["__rest"]) for r in _reached(blocks, "__block", "__part").select("__i", "__block", "__rest").collect()}
    end_rows = spark.createDataFrame([(i, *x) for i, x in last.items()], "__i int, __last long, __least long")
    inside = by_source.join(_small(end_rows, len(last)), "__i").where(__block(spec) == F.col("__last")).withColumn("__in", __part(spec))
    parts = inside.groupBy("__i", "__least", "__in").agg(F.sum("size").alias("w"))
    within = {r["__i"]: (r["__in"], r["__rest"]) for r in _reached(parts, "__in", "__least").select("__i", "__in", "__rest").collect()}
    part_rows = spark.createDataFrame([(i, *x) for i, x in within.items()], "__i int, __in long, __least long")
    few = inside.drop("__least").join(_small(part_rows, len(within)), ["__i", "__in"]).groupBy("__i", "__least", "__hash").agg(F.sum("size").alias("w"), F.count("*").alias("n"))
    cuts = _reached(few, "__hash", "__least").select("__i", "__hash", F.expr("__rest div n").alias("__cut"))
    cut = {r["__i"]: (within[r["__i"]][0], r["__hash"], r["__cut"]) for r in cuts.collect()}
    counts = [p * spec.blocks + (last[i][0] + 1 if i in last else 0) for i, _, _, _, p, _ in rows]
    tree = splitting_tree(np.asarray(counts, dtype=np.int64), spec.shards, spec.seed)
    full = [
        (i, s, size, t, p, *(last[i][:1] if i in last else (-1,)), *cut.get(i, (None, None, 0)), tree[i].tolist())
        for i, s, size, t, p, _ in rows
    ]
    schema = "__i int, __source string, source_size long, target double, __passes int, __last long, __in long, __cut_hash long, __cut long, __left array<long>"
    return spark.createDataFrame(full, schema)


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint for a table whose rows the driver has counted; else the join is left to AQE."""
    return F.broadcast(df) if rows <= 20_000 else df


def mix(docs: DataFrame, spec: MixSpec = MixSpec(), text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """docs with size, source_size, target, taken and copies.

    copies: array of (pass, words, shard, order) for each time the document is in the mix;
    taken is the sum of their words.  words is less than size only in the one document of
    a source at which the mix ends.  The seed fixes the result: reruns agree.

    A null text has no words and is never taken (taken 0); null is a source of its own.
    Repeated rows share a place in the order; where the cut falls on them, each gets an
    equal part.  A source without words has target 0.  No rows give no rows.  Columns of
    docs named like the new ones give way, all others are kept.
    """
    docs = docs.drop("size", "source_size", "target", "taken", "copies")
    df = sized(docs, spec, text, source, key)
    slim = stored(sized(docs.select(*dict.fromkeys([key, text, source])), spec, text, source, key).select("__source", "__hash", "size"))
    plan = plan_sources(slim, spec)
    df = df.join(_small(plan, plan.count()), df["__source"].eqNullSafe(plan["__source"]), "left").drop(plan["__source"])
    block = __block(spec)
    partial = (
        F.when(block < F.col("__last"), F.col("size"))
        .when((block == F.col("__last")) & ((__part(spec) < F.col("__in")) | (__part(spec) == F.col("__in")) & (F.col("__hash") < F.col("__cut_hash"))), F.col("size"))
        .when((block == F.col("__last")) & (F.col("__hash") == F.col("__cut_hash")), F.least("size", "__cut"))
        .otherwise(F.lit(0))
    )
    df = df.withColumn("__partial", F.coalesce(partial, F.lit(0)).cast("long"))
    depth = spec.shards.bit_length() - 1

    def shard(number: Column) -> Column:
        """Walk the tree: a block numbered below the node's left count goes left."""
        step = lambda s, _: F.struct(
            F.when(s["t"] < F.get(F.col("__left"), s["n"]), 2 * s["n"]).otherwise(2 * s["n"] + 1).cast("int").alias("n"),
            F.when(s["t"] < F.get(F.col("__left"), s["n"]), s["t"]).otherwise(s["t"] - F.get(F.col("__left"), s["n"])).alias("t"),
        )
        start = F.struct(F.lit(1).cast("int").alias("n"), number.cast("long").alias("t"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), start, step, lambda s: s["n"] - F.lit(spec.shards)) if depth else F.lit(0)

    one = lambda p: F.struct(
        F.lit(p).alias("pass"),
        F.when(F.col("__passes") > p, F.col("size")).when(F.col("__passes") == p, F.col("__partial")).otherwise(F.lit(0)).cast("long").alias("words"),
        shard(F.lit(p * spec.blocks) + block).alias("shard"),
        F.xxhash64(F.lit(spec.seed + 1 + p), "__hash").alias("order"),
    )
    copies = F.filter(F.array(*[one(p) for p in range(int(spec.most) + 1)]), lambda c: c["words"] > 0)
    inner = ["__source", "__hash", "__i", "__passes", "__last", "__in", "__cut_hash", "__cut", "__left", "__partial"]
    df = df.withColumn("copies", copies).drop(*inner)
    return df.withColumn("taken", F.aggregate(F.col("copies.words"), F.lit(0).cast("long"), lambda a, w: a + w))


def materialise(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself: a row per copy with pass and shard; the text of a cut document ends
    after its last word that is taken.  shard and order give each shard's local shuffle.
    """
    own = ["size", "source_size", "target", "taken", "copies"]
    df = mixed.withColumn("__copy", F.explode("copies")).drop("pass", "shard", "order")
    # each piece is a word and the white space before it, so what is kept is a whole start
    pieces = F.regexp_extract_all(F.col(text), F.lit(f"{SPACE_CLASS}*{WORD_PATTERN}"), F.lit(0))
    head = F.array_join(F.slice(pieces, 1, F.col("__copy.words").cast("int")), "")
    df = df.withColumn(text, F.when(F.col("__copy.words") < F.col("size"), head).otherwise(F.col(text)))
    return df.withColumns({"pass": F.col("__copy.pass"), "shard": F.col("__copy.shard"), "order": F.col("__copy.order")}).drop("__copy", *own)


def in_shards(rows: DataFrame, shards: int = MixSpec().shards) -> DataFrame:
    """The rows of materialise() by shard, each shard in its shuffled order.

    A shard is one partition, or some that follow each other where shuffle partitions are
    many: order is uniform, so its ranges are equal and nothing is sampled.
    """
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards)
    share = F.col("order").cast("double") / F.lit(2.0**64) + 0.5
    part = F.col("shard") * parts + F.least(F.floor(share * parts), F.lit(parts - 1)).cast("int")
    return rows.repartitionById(shards * parts, part).sortWithinPartitions("shard", "order")


def write_shards(mixed: DataFrame, path: str, text: str = "text") -> None:
    """Write the mix as one folder per shard, rows in the shard's shuffled order."""
    rows = materialise(mixed, text)
    rows.repartition("shard").sortWithinPartitions("shard", "order").write.partitionBy("shard").parquet(path)
