"""Line dedup with a segment-partition edit join.

Two lines are linked if their edit distance is at most TAU and at most a share of the longer
one.  A line is split into TAU + 1 segments, one of which any line within TAU edits must
contain near its place; so lines meet at (length, segment number, segment) keys.  A banded
bit-parallel automaton verifies what meets.  Of each class of linked lines the first in
the corpus stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import CHUNK_BYTES, WORD_PATTERN, by_group, deal_blocks, discard, mix64, powers, stored, text_chunks
from tessera.operators.graph import connected_components

TAU = 2
#: Edits allowed per character of the longer line.
RATIO = 0.1
#: Classes of characters that are counted before two lines are compared.
CLASSES = 32
#: Lines and bytes that one task compares at once; a key with more is dealt out as pairs of
#: blocks of half that.
BLOCK_LINES, BLOCK_BYTES = 4_096, 16 << 20
#: Numbers of lines that a task remembers, so as to list equal lines once.
SEEN = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1


def segments(length: np.ndarray, i: int, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of segment i of lines of this length; sizes differ by one at most, the longer ones last."""
    small, extra = length // (tau + 1), length % (tau + 1)
    long_before = np.maximum(0, i - (tau + 1 - extra))
    return i * small + long_before, small + (i >= tau + 1 - extra)


_tables: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, kept per worker."""
    if not _tables or len(_tables[0]) < n:
        most = max(n, CHUNK_BYTES + 1)
        _tables[:] = [powers(most, _BASE), powers(most, pow(_BASE, -1, 1 << 64))]
    return _tables[0][:n], _tables[1][:n]


def line_keys(data: np.ndarray, offsets: np.ndarray, tau: int, shortest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, is index) of the lines of a chunk that have the shortest length or more.

    A line is listed under its own segments and probes those of lines up to tau shorter, at
    the starts where tau edits left and right of the segment allow it to stand.
    """
    n = len(data)
    lead = (data & 0xC0) != 0x80  # first bytes of characters
    char_at = np.append(np.flatnonzero(lead), n)
    before = np.concatenate([[0], np.cumsum(lead)])
    first = before[offsets[:-1]]
    length = before[offsets[1:]] - first
    table, inverse = _powers(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * table[:n], out=prefix[1:])
    rows = np.flatnonzero(length >= shortest)
    size, start = length[rows], first[rows]
    out_row, out_key, out_index = [], [], []

    def emit(keep: np.ndarray, other: np.ndarray, i: int, at: np.ndarray, chars: np.ndarray, index: bool) -> None:
        a, b = char_at[start[keep] + at], char_at[start[keep] + at + chars]
        plain = (prefix[b] - prefix[a]) * inverse[a]
        out_row.append(rows[keep])
        out_key.append(mix64(plain + mix64((other * 64 + i * 8).astype(np.uint64) ^ ((b - a).astype(np.uint64) << np.uint64(32)))))
        out_index.append(np.full(len(a), index))

    everyone = np.arange(len(rows))
    for i in range(tau + 1):
        at, chars = segments(size, i, tau)
        emit(everyone, size, i, at, chars, True)
        for less in range(tau + 1):
            other = size - less
            at, chars = segments(other, i, tau)
            for shift in range(max(-i, less - (tau - i)), min(i, less + (tau - i)) + 1):
                if less == 0 and shift == 0:
                    continue  # the line's own segment: listed there already
                keep = np.flatnonzero((other >= shortest) & (at + shift >= 0) & (at + shift + chars <= size))
                emit(keep, other[keep], i, (at + shift)[keep], chars[keep], False)
    return np.concatenate(out_row), np.concatenate(out_key), np.concatenate(out_index)


KEY_SCHEMA = "key long, line long, own boolean"
GROUP_SCHEMA = "key long, head long, line long, own boolean"


def _key_rows(lines: DataFrame, tau: int, shortest: int) -> DataFrame:
    """KEY_SCHEMA rows of lines (line, text); equal lines that a task meets are listed once as a rule."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if len(seen) > SEEN:  # listed anew, which changes no group
                seen = set()
            new = [i for i, x in enumerate(ids.tolist()) if x not in seen and not seen.add(x)]
            ids, texts = ids[new], batch.column(1).take(pa.array(new, pa.int64()))
            for lo, _, data, offsets in text_chunks(texts):
                row, key, own = line_keys(data, offsets, tau, shortest)
                yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(ids[lo + row]), pa.array(own)], names=["key", "line", "own"])

    return lines.mapInArrow(run, KEY_SCHEMA)


def _groups(keys: DataFrame) -> DataFrame:
    """GROUP_SCHEMA rows: each line that meets another one, listed line at a key; head is the
    key's smallest listed line.  A task streams over sorted rows and holds one batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # key, head, whether it is listed, line of the row before
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key, line = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            own = batch.column(2).to_numpy(zero_copy_only=False)
            fresh = np.ones(n, bool)
            fresh[1:] = key[1:] != key[:-1]
            fresh[0] = before is None or key[0] != before[0]
            begin = np.maximum.accumulate(np.where(fresh, np.arange(n), -1))
            head, listed, last = line[begin], own[begin], np.roll(line, 1)
            if before is not None:
                head, listed = np.where(begin < 0, before[1], head), np.where(begin < 0, before[2], listed)
                last[0] = before[3]
            keep = np.flatnonzero(~fresh & listed & (line != head) & (line != last))
            before = key[-1], head[-1], listed[-1], line[-1]
            if len(keep):
                yield pa.record_batch([pa.array(x[keep]) for x in (key, head, line, own)], names=["key", "head", "line", "own"])

    return keys.repartition("key").sortWithinPartitions("key", F.desc("own"), "line").mapInArrow(run, GROUP_SCHEMA)


PAIR_SCHEMA = "src long, dst long"


def count_classes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, CLASSES) bytes: how often each class of characters stands in the text, modulo 256."""
    cls = (mix64(np.arange(256, dtype=np.uint64) + np.uint64(77)) % np.uint64(CLASSES)).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    lead = (data & 0xC0) != 0x80
    both = np.bincount(row[lead] * CLASSES + cls[data[lead]], minlength=(len(offsets) - 1) * CLASSES)
    return both.reshape(-1, CLASSES).astype(np.uint8)


def _near_counts(a: np.ndarray, b: np.ndarray, tau: int) -> np.ndarray:
    """Whether the counts of classes allow tau edits: each changes two of them by one at most.

    A difference is taken modulo 256, which can only let more pass.
    """
    gap = (a - b).astype(np.uint8)
    gap = np.minimum(gap, (256 - gap.astype(np.int16)).astype(np.uint8))
    return gap.sum(axis=-1, dtype=np.int32) <= 2 * tau


def cross_links(groups: DataFrame, texts: DataFrame, found: DataFrame, tau: int, ratio: float) -> DataFrame:
    """(src < dst): links between lines of a key that are in different components, enough to
    connect what they connect; groups: GROUP_SCHEMA, found: (node, component) so far.

    A task compares the lines of a key, or of two blocks of them if they are many or long:
    first the counts of their characters, then the lines themselves, and never two lines
    that are connected already.  Pairs are neither emitted nor shuffled.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_group(batches, ["key", "one", "two"]):
            line, comp, block = (table.column(c).to_numpy() for c in ("line", "component", "block"))
            one, two = table.column("one")[0].as_py(), table.column("two")[0].as_py()
            own = table.column("own").combine_chunks().to_numpy(zero_copy_only=False)
            body = table.column("text").to_pylist()
            classes = np.concatenate([count_classes(data, offsets) for _, _, data, offsets in text_chunks(table.column("text"))])
            comp, out = comp.copy(), []
            for x in range(len(line) - 1):
                y = np.arange(x + 1, len(line))
                y = y[(comp[y] != comp[x]) & (own[y] | own[x])]
                if one != two:
                    y = y[block[y] != block[x]]  # a block against itself is another task's work
                y = y[_near_counts(classes[y], classes[x], tau)]
                for z in y.tolist():
                    if comp[z] != comp[x] and _linked(body[x], body[z], tau, ratio):
                        out.append((min(int(line[x]), int(line[z])), max(int(line[x]), int(line[z]))))
                        comp[comp == comp[z]] = comp[x]
            yield pa.record_batch([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], names=["src", "dst"])

    members = groups.select("key", "line", "own").union(groups.select("key", F.col("head").alias("line"), F.lit(True).alias("own"))).groupBy("key", "line").agg(F.max("own").alias("own"))
    placed = members.join(found.withColumnRenamed("node", "line"), "line", "left").withColumn("component", F.coalesce("component", "line"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    placed = stored(placed.join(mixed, "key", "left_semi").join(texts.select("line", F.octet_length("text").alias("size")), "line"))
    dealt, homes = deal_blocks(placed, "key", "line", "component", F.col("size"), BLOCK_LINES, BLOCK_BYTES)
    dealt = dealt.join(texts, "line")
    out = stored(dealt.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two", "block").mapInArrow(meet, PAIR_SCHEMA).distinct())
    discard(placed, homes)
    return out


def edit_distance_within(a: str, b: str, tau: int) -> int | None:
    """The edit distance of a and b if it is at most tau, else None.

    Equal ends are cut off.  Then tau + 1 bit rows, one per number of edits, hold which of
    the 2 * tau + 1 diagonals of the band can be reached; a step per character of b moves
    all diagonals at once, and stops once none is left.
    """
    if abs(len(a) - len(b)) > tau:
        return None
    if a == b:
        return 0
    low, high = 0, min(len(a), len(b))
    while low < high:  # longest equal start, by halving
        mid = (low + high + 1) >> 1
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    a, b = a[low:], b[low:]
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) >> 1
        low, high = (mid, high) if a[len(a) - mid :] == b[len(b) - mid :] else (low, mid - 1)
    a, b = a[: len(a) - low], b[: len(b) - low]
    if not a or not b:
        return len(a) + len(b)
    width = 2 * tau + 1
    band = (1 << width) - 1
    rows = [((1 << (d + 1)) - 1) << tau & band for d in range(tau + 1)]  # bit x: a's first i - tau + x characters
    for i, ch in enumerate(b):
        at = 0
        for x, other in enumerate(a[max(i - tau, 0) : i + tau + 1], max(tau - i, 0)):
            at |= (other == ch) << x
        kept, made = rows, []
        for d in range(tau + 1):
            now = kept[d] & at
            if d:
                now |= kept[d - 1] | kept[d - 1] >> 1 | made[d - 1] << 1
            made.append(now & band)
        rows = made
        if not rows[tau]:
            return None
    end = 1 << (len(a) - len(b) + tau)
    return next((d for d in range(tau + 1) if rows[d] & end), None)


def _linked(a: str, b: str, tau: int, ratio: float) -> bool:
    d = edit_distance_within(a, b, tau)
    return d is not None and d <= ratio * max(len(a), len(b))


def linked_lines(pairs: DataFrame, texts: DataFrame, tau: int, ratio: float) -> DataFrame:
    """The pairs whose lines are within the threshold.  texts: (line, text), one per line."""
    a = texts.select(F.col("line").alias("src"), F.col("text").alias("a"))
    b = texts.select(F.col("line").alias("dst"), F.col("text").alias("b"))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(src, dst) for src, dst, x, y in batch.itertuples(index=False) if _linked(x, y, tau, ratio)]
            yield pd.DataFrame(out, columns=["src", "dst"], dtype="int64")

    return pairs.join(a, "src").join(b, "dst").select("src", "dst", "a", "b").mapInPandas(verify, PAIR_SCHEMA)


def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", tau: int = TAU, ratio: float = RATIO) -> DataFrame:
    """docs with text without repeated lines, and n_lines, n_removed (long).

    Lines are split at \\n; only lines with a word take part, others stay.  Equal lines are
    linked, and lines whose edit distance (in characters) is at most tau and at most ratio
    times the longer one's length.  Of each class the line of the smallest doc_id, then
    the smallest line number, stays; the others go.  Links are looked for in two rounds:
    each key's lines against its smallest, then lines still in different classes.

    A null text stays null and has no lines; an empty one has none either.  A null doc_id
    counts as the largest.  Rows with equal doc_id: a line that is the first of its class
    stays in all of them where it has the same number.  Long lines are verified whole.  No
    rows give no rows.  Columns named n_lines or n_removed give way, others are kept.
    """
    if not 1 <= tau <= TAU:
        raise ValueError(f"tau is 1 to {TAU}")
    word = WORD_PATTERN[:-1]
    own = F.coalesce(F.col(key).cast("long"), F.lit((1 << 63) - 1))
    exploded = docs.select(own.alias("doc"), F.xxhash64(text).alias("th"), F.posexplode(F.split(F.col(text), "\n")).alias("no", "text"))
    exploded = exploded.where(F.col("text").rlike(word)).withColumns({"line": F.xxhash64("text"), "check": F.xxhash64(F.lit(1), "text")})
    occurrences = stored(exploded.drop("text"))
    lines = stored(occurrences.groupBy("line", "check").agg(F.min(F.struct("doc", "no", "th")).alias("at"), F.count("*").alias("c")))
    shortest = int(1 / ratio) - 1 if ratio < 1 else tau + 1
    groups = stored(_groups(_key_rows(exploded.select("line", "text"), tau, max(shortest, tau + 1))))
    met = groups.select("line").union(groups.select(F.col("head").alias("line"))).distinct()
    met = met.join(lines, "line").select("line", "check", "at.doc", "at.no", "at.th")
    texts = exploded.join(met, ["line", "check", "doc", "no", "th"]).groupBy("line").agg(F.min(F.struct("check", "text")).alias("first"))
    texts = stored(texts.select("line", "first.check", "first.text"))
    first = groups.select(F.least("head", "line").alias("src"), F.greatest("head", "line").alias("dst")).distinct()
    links = stored(linked_lines(first, texts, tau, ratio))
    round_one = stored(connected_components(links))
    more = cross_links(groups, texts.select("line", "text"), round_one, tau, ratio)
    found = connected_components(links.union(more))
    # of two lines with one number only that whose text was compared is in a class
    found = stored(found.join(texts.select("line", "check"), found["node"] == texts["line"]).select("line", "check", "component"))
    # the place that stays for every line that has another place, or another line, in its class
    marked = lines.join(found, ["line", "check"], "left")
    near = marked.where("component is not null")
    heads = near.groupBy("component").agg(F.min("at").alias("head"))
    stays = near.join(heads, "component").select("line", "check", "head").union(marked.where("component is null and c > 1").select("line", "check", F.col("at").alias("head")))
    gone = occurrences.join(stays, ["line", "check"]).where((F.col("doc") != F.col("head.doc")) | (F.col("no") != F.col("head.no")))
    gone = gone.groupBy("doc", "th").agg(F.sort_array(F.collect_set("no")).alias("gone"))  # line numbers of one document
    gone = stored(gone.withColumnsRenamed({"doc": "__doc", "th": "__th", "gone": "__gone"}))
    discard(occurrences, lines, groups, texts, links, round_one, more, found)
    out = docs.drop("n_lines", "n_removed").withColumns({"__own": own, "__hash": F.xxhash64(text)})
    out = out.join(gone, (F.col("__own") == F.col("__doc")) & (F.col("__hash") == F.col("__th")), "left")
    out = out.withColumn("__lines", F.split(F.col(text), "\n"))
    # the stretches between lines that go, so that a document is worked through once
    after = lambda j: F.coalesce(F.get("__gone", j - 1), F.lit(-1)) + 1
    until = lambda j: F.coalesce(F.get("__gone", j), F.size("__lines"))
    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size("__gone")), lambda j: F.slice("__lines", after(j) + 1, until(j) - after(j))))
    return out.withColumns(
        {
            text: F.when(F.col("__gone").isNotNull(), F.array_join(kept, "\n")).otherwise(F.col(text)),
            "n_lines": F.coalesce(F.size(F.filter("__lines", lambda x: x.rlike(word))), F.lit(0)).cast("long"),
            "n_removed": F.coalesce(F.size("__gone"), F.lit(0)).cast("long"),
        }
    ).drop("__own", "__hash", "__doc", "__th", "__gone", "__lines")
