"""Packing by optimal length buckets.

The lengths of all documents are counted; dynamic programming over this histogram chooses
the bucket boundaries that give the least padding; batches of at most a token budget form
inside each bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import stored, word_count


@dataclass(frozen=True)
class PackSpec:
    """buckets: how many; budget: padded tokens of a batch (a longer document is a batch of
    its own); exact: lengths up to this have histogram bins of their own, longer ones share
    bins whose width is a 1/fine part of their length; group: about how many documents form
    batches together, at most one batch of each group is not full.
    """

    buckets: int = 16
    budget: int = 65_536
    exact: int = 2_048
    fine: int = 256
    group: int = 8_192


def length_bin(length: Column, spec: PackSpec) -> Column:
    """The bin's number, increasing with the length.

    Lengths of [exact * 2**k, exact * 2**(k+1)) have fine bins, so the number of bins grows
    with the logarithm of the longest text only.
    """
    over = F.greatest(length, F.lit(spec.exact)).cast("double") / F.lit(float(spec.exact))
    octave = F.floor(F.log2(over))
    part = F.floor((over / F.pow(F.lit(2.0), octave) - 1) * spec.fine)
    return F.when(length < spec.exact, length).otherwise(spec.exact + octave * spec.fine + part).cast("long")


def best_buckets(longest: np.ndarray, counts: np.ndarray, tokens: np.ndarray, buckets: int) -> list[int]:
    """Indices of the last bin of each bucket, with the least padding in all.

    longest, counts, tokens: per bin, ascending: the longest length in it, its documents,
    and the sum of their lengths.  A bucket pads to its longest document.  Ties take the
    fewest buckets, then the earliest boundaries.
    """
    n = len(longest)
    if not n:
        return []
    c, t = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(tokens)])
    best = longest * c[1:] - t[1:]
    back = [np.zeros(n, np.int64)]
    costs = [best]
    for _ in range(1, min(buckets, n)):
        previous, best, came = best, np.empty(n, np.int64), np.zeros(n, np.int64)
        for j in range(n):
            # the last bucket holds bins i..j; before it, the best for bins below i
            pad = longest[j] * (c[j + 1] - c[: j + 1]) - (t[j + 1] - t[: j + 1])
            total = pad + np.concatenate([[0], previous[:j]])
            came[j] = int(np.argmin(total))
            best[j] = total[came[j]]
        costs.append(best)
        back.append(came)
    k = int(np.argmin([x[-1] for x in costs]))
    out, j = [], n - 1
    while j >= 0:
        out.append(j)
        j = int(back[k][j]) - 1
        k -= 1
    return out[::-1]


def bucket_table(slim: DataFrame, spec: PackSpec) -> list[tuple[int, int, int, int]]:
    """(first bin, last bin, longest length, documents) of each bucket; slim has length.

    The driver gets a row per bin: some thousands, whatever the number of documents.
    """
    rows = (
        slim.groupBy(length_bin(F.col("length"), spec).alias("bin"))
        .agg(F.count("*").alias("n"), F.sum("length").alias("tokens"), F.max("length").alias("longest"))
        .collect()
    )
    rows.sort(key=lambda r: r["bin"])
    longest, n, tokens = (np.asarray([r[k] for r in rows], dtype=np.int64) for k in ("longest", "n", "tokens"))
    out, first = [], 0
    for last in best_buckets(longest, n, tokens, spec.buckets):
        out.append((rows[first]["bin"], rows[last]["bin"], int(longest[last]), int(n[first : last + 1].sum())))
        first = last + 1
    return out


def pack(docs: DataFrame, spec: PackSpec = PackSpec(), text: str = "text", key: str = "doc_id", length: Column | None = None) -> DataFrame:
    """A row per document: the key, length, bucket, padded_length, batch_group, batch and slot.

    A batch is (bucket, batch_group, batch); slot numbers its documents from 0 and
    (slots) * padded_length is at most the budget, except for a document longer than the
    budget, which is alone.  length defaults to the number of words.

    Null and empty texts have length 0 and go to the first bucket (a batch of nothing but
    empty texts is bounded by the budget as a count).  Repeated rows are packed each.  No
    rows give no rows.  Only the key is carried, so other columns cannot clash.
    """
    size = (length if length is not None else word_count(F.col(text))).cast("long")
    slim = stored(docs.select(F.col(key).alias("_key"), size.alias("length"), F.xxhash64(key, text).alias("_hash")))
    table = bucket_table(slim, spec)
    if not table:
        table = [(0, 0, 0, 0)]
    bins, bucket, padded, groups, room = length_bin(F.col("length"), spec), F.lit(None), F.lit(None), F.lit(None), F.lit(None)
    for i, (_, last, longest, n) in reversed(list(enumerate(table))):
        here = F.col("_bin") <= last
        bucket = F.when(here, i).otherwise(bucket)
        padded = F.when(here, F.lit(longest).cast("long")).otherwise(padded)
        groups = F.when(here, max(1, -(-n // spec.group))).otherwise(groups)
        room = F.when(here, max(1, spec.budget // max(longest, 1))).otherwise(room)
    df = slim.withColumn("_bin", bins).withColumns({"bucket": bucket.cast("int"), "padded_length": padded, "_groups": groups, "_room": room})
    df = df.withColumn("batch_group", F.pmod(F.col("_hash"), F.col("_groups")).cast("int"))
    place = F.row_number().over(W.partitionBy("bucket", "batch_group").orderBy("_hash", "_key")) - 1
    df = df.withColumn("_place", place.cast("long"))
    # a document longer than the budget alone would not fit with others: its room is 1
    df = df.withColumns({"batch": F.expr("_place div _room"), "slot": F.expr("_place % _room").cast("int")})
    return df.select(F.col("_key").alias(key), "length", "bucket", "padded_length", "batch_group", "batch", "slot")
