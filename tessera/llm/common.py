"""Shared pieces of the corpus operators: words, scratch tables, Arrow byte access."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.scratch import discard, scratch_dir, stored, stored_by

__all__ = ["scratch_dir", "stored", "stored_by", "discard", "words", "word_count", "text_chunks", "mix64", "powers", "word_hashes", "shingles", "by_group", "deal_blocks"]

#: A word is a run of anything but ASCII white space.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Bytes of text that one numpy pass works on at once (a longer text is one pass).
CHUNK_BYTES = 1 << 20


def words(text: Column) -> Column:
    """Array of the text's words; null for a null text is an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words as long; a null text has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_PATTERN)).cast("long")


def text_chunks(column: pa.Array | pa.ChunkedArray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut an Arrow string column into (first row, end row, bytes, offsets).

    bytes holds the rows' UTF-8 texts one after another, offsets where each begins
    (one more than rows, from 0).  Nulls are empty texts.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64, count=n + 1, offset=column.offset * 8)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(at, at[lo] + most, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, whole[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (xor-shift-multiply)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BASE = 0x9E3779B97F4A7C15 | 1


def powers(n: int, base: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word of the chunk, and each row's first word (rows + 1).

    A word never crosses rows.  lower folds A-Z only.
    """
    n = len(data)
    rows = len(offsets) - 1
    if not n:
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    space = _IS_SPACE[data]
    begins = ~space
    begins[1:] &= space[:-1]
    inner = offsets[:-1][offsets[:-1] < n]
    begins[inner] = ~space[inner]
    ends = ~space
    ends[:-1] &= space[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    ends[last] = ~space[last]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    # Position within the word as exponent: a word's hash does not depend on its place.
    number = np.cumsum(begins, dtype=np.int64) - 1
    body = np.flatnonzero(~space)
    number = number[body]
    within = body - starts[number] if len(starts) else body
    values = (_LOWER[data[body]] if lower else data[body]).astype(np.uint64) + np.uint64(1)
    table = powers(int(within.max(initial=0)) + 1, _BASE)
    sums = np.add.reduceat(values * table[within], starts_in(body, starts)) if len(starts) else np.zeros(0, np.uint64)
    hashes = mix64(sums ^ ((stops - starts).astype(np.uint64) << np.uint64(56)))
    return hashes, np.searchsorted(starts, offsets).astype(np.int64)


def starts_in(body: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where each word's first byte stands among the bytes that are in words."""
    return np.searchsorted(body, starts)


def shingles(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word windows of each row, and each row's first window (rows + 1).

    A row with fewer words has its whole sequence as one window, one without words none.
    """
    counts = np.diff(first)
    made = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    out_first = np.concatenate([[0], np.cumsum(made)])
    total = int(out_first[-1])
    row = np.repeat(np.arange(len(counts)), made)
    start = first[:-1][row] + (np.arange(total) - out_first[:-1][row])
    acc = np.full(total, np.uint64(0x632BE59BD9B4E019), np.uint64)
    room = first[1:][row] - start
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    for k in range(n):
        has = k < room
        acc = np.where(has, mix64(acc * np.uint64(0x9FB21C651E98DF25) + padded[start + k] + np.uint64(k)), acc)
    return acc, out_first


def by_group(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of batches that are sorted by the keys, one table each."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if held and (k or first != last):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def deal_blocks(rows: DataFrame, group: str, member: str, component: str, size: Column, most: int, most_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(rows with block, one and two: the blocks of the group whose members a task compares
    (equal for the inside of a block); a stored table that the rows read, to be discarded
    after them).

    Members of one component need no comparison, so a group of one component gives no rows.
    In others the component with the most members is home.  Home and the rest are dealt by
    hash into blocks of at most half of most members and most_bytes of size; a rest member
    goes to every pair of blocks that has its own, a home member to those with a rest block.
    So a large home and few others cost no more than the home's blocks.
    """
    sizes = rows.groupBy(group, component).agg(F.count("*").alias("__c"), F.sum(size).alias("__b"))
    homes = sizes.groupBy(group).agg(
        F.max(F.struct("__c", "__b", component)).alias("__home"), F.sum("__c").alias("__c"), F.sum("__b").alias("__b"), F.count("*").alias("__k")
    ).where("__k > 1")
    blocks = lambda c, b: F.greatest(F.ceil(2 * c / most), F.least(F.ceil(2 * b / most_bytes), c), F.lit(1)).cast("int")
    rest = F.col("__c") - F.col("__home.__c"), F.col("__b") - F.col("__home.__b")
    homes = homes.select(
        group, F.col(f"__home.{component}").alias("__at_home"), blocks(*rest).alias("__rest"), blocks(F.col("__home.__c"), F.col("__home.__b")).alias("__own"),
        ((F.col("__c") <= most) & (F.col("__b") <= most_bytes)).alias("__single"),
    )
    # stored, so that both sides of the join are plain exchanges, which AQE can split at a hot group
    homes = stored(homes, small=True)
    rows = rows.join(homes, group).withColumn("__in", F.col(component) == F.col("__at_home"))
    place = F.when(F.col("__in"), F.col("__rest") + F.pmod(F.xxhash64(member), F.col("__own"))).otherwise(F.pmod(F.xxhash64(member), F.col("__rest")))
    rows = rows.withColumn("block", F.when(F.col("__single"), 0).otherwise(place).cast("int"))
    last = F.when(F.col("__single"), 0).when(F.col("__in"), F.col("__rest") - 1).otherwise(F.col("__rest") + F.col("__own") - 1)
    pairs = F.transform(F.sequence(F.lit(0), last), lambda x: F.struct(F.least("block", x).alias("one"), F.greatest("block", x).alias("two")))
    rows = rows.withColumn("__p", F.explode(pairs)).withColumns({"one": F.col("__p.one"), "two": F.col("__p.two")})
    return rows.drop("__at_home", "__rest", "__own", "__single", "__in", "__p"), homes
