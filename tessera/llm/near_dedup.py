"""MinHash near-dedup with bottom-k sketches from one hash function.

Every document's set of word shingles is hashed once.  Its smallest values are retained:
INDEX of them make inverted lists, SKETCH of them estimate the resemblance of two documents
from the sketch of their union, and the whole sets confirm a link.  Equal sets are one node.
Lists with the same smallest node are one group, so that a set of near copies, which share
most values, is compared once and not once per value.  A group's nodes are first compared
with its smallest one; only nodes of different components are then compared with each other.
A task returns links that connect what is linked, in number less than the nodes: pairs are
neither emitted nor shuffled.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import by_group, deal_blocks, discard, shingles, stored, text_chunks, word_hashes
from tessera.operators.graph import connected_components

#: Retained values per document that make inverted lists, and that make its sketch.
INDEX, SKETCH = 32, 128
#: Chance per linked pair that a filter on retained values misses it.
MISS = 1e-7
#: Nodes and bytes of texts that one task compares with each other at most, and nodes that it
#: compares with their group's smallest.
BLOCK, BLOCK_BYTES, STAR = 1_024, 32 << 20, 128
#: Ids that are broadcast to fetch their texts at most (32 MB); more are joined by a shuffle of the texts.
FETCH = 1 << 21


@dataclass(frozen=True)
class NearSpec:
    """Shingles of n words; a link needs |A & B| / |A | B| >= percent / 100.

    miss: the chance per linked pair that a filter on retained values misses it.  0 is exact:
    whole sets make the inverted lists and nothing is estimated.
    """

    n: int = 5
    percent: int = 80
    miss: float = MISS


def least_shared(k: int, share: float, miss: float) -> int:
    """The largest s so that fewer than s of k draws of chance share have a chance of at most miss."""
    total = 0.0
    for s in range(k + 1):
        total += math.comb(k, s) * share**s * (1 - share) ** (k - s)
        if total > miss:
            return max(1, s)
    return k


SKETCH_SCHEMA = "doc_id long, n_shingles long, print binary, low array<long>, sketch binary"


def sketch_documents(docs: DataFrame, spec: NearSpec, text: str, key: str) -> DataFrame:
    """(doc_id, n_shingles, print: digest of the whole set, low: the INDEX smallest values
    (all where nothing may be missed), sketch: the upper halves of the SKETCH smallest values).  No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            for lo, hi, data, offsets in text_chunks(batch.column(1)):
                values, first = shingles(*word_hashes(data, offsets), spec.n)
                sizes, prints, lows, sketches = [], [], [], []
                for i in range(hi - lo):
                    own = np.unique(values[first[i] : first[i + 1]])
                    sizes.append(len(own))
                    prints.append(hashlib.md5(own.tobytes()).digest())
                    lows.append((own[:INDEX] if spec.miss else own).view(np.int64))
                    sketches.append((own[:SKETCH] >> np.uint64(32)).astype(np.uint32).tobytes())
                yield pa.record_batch(
                    [
                        keys.slice(lo, hi - lo),
                        pa.array(sizes, pa.int64()),
                        pa.array(prints, pa.binary()),
                        pa.array(lows, pa.list_(pa.int64())),
                        pa.array(sketches, pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "print", "low", "sketch"],
                )

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SKETCH_SCHEMA)


def inverted_lists(nodes: DataFrame, spec: NearSpec) -> DataFrame:
    """(leader, node): the groups of each node, named by the smallest node of its lists.

    A linked pair shares at least need of its retained values; so each node is listed under
    its rarest values only, one more than it can lack.  Common values (a line or passage that
    very many documents have) thus drop out by themselves, and a value that one node alone
    has lists nothing.
    """
    share = spec.percent / 100
    rows = nodes.select("node", "n", F.size("low").alias("m"), F.explode("low").alias("value"))
    counts = rows.groupBy("value").agg(F.count("*").alias("df"), F.min("node").alias("leader")).where("df > 1")
    shared = rows.join(counts, "value").groupBy("node", "n", "m").agg(
        F.sort_array(F.collect_list(F.struct("df", "value", "leader"))).alias("own")  # one document's values
    )
    need = F.ceil(F.col("m") * share - 1e-9)
    if spec.miss:
        need = F.when(F.col("n") <= int(INDEX * share), need).otherwise(F.least(need, F.lit(least_shared(INDEX, share, spec.miss))))
    keep = F.col("m") - F.greatest(need, F.lit(1)) + 1 - (F.col("m") - F.size("own"))
    kept = shared.select("node", F.explode(F.slice("own", 1, F.greatest(keep, F.lit(0)).cast("int"))).alias("o"))
    return kept.select("o.leader", "node").distinct()


def shared_counts(values: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """(n, n) numbers of values that two rows share; values are distinct within a row.

    Values of few rows are counted pair by pair, those of many by products of 0/1 columns.
    """
    by = np.argsort(values, kind="stable")
    values, row = values[by], row[by]
    begin = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    df = np.diff(np.append(begin, len(values)))
    out = np.zeros((n, n), np.float32)
    for d in range(2, 9):
        at = begin[df == d]
        if len(at):
            rows = row[at[:, None] + np.arange(d)]
            i, j = np.triu_indices(d, 1)
            pairs = (rows[:, i] * n + rows[:, j]).ravel()
            out += np.bincount(pairs, minlength=n * n).reshape(n, n)
    out += out.T
    heavy = np.flatnonzero(df > 8)
    for lo in range(0, len(heavy), 2_048):
        part = heavy[lo : lo + 2_048]
        columns = np.zeros((n, len(part)), np.float32)
        which = np.repeat(np.arange(len(part)), df[part])
        at = np.repeat(begin[part], df[part]) + np.arange(len(which)) - np.repeat(np.cumsum(df[part]) - df[part], df[part])
        columns[row[at], which] = 1
        out += columns @ columns.T
    return out


def _estimate(a: np.ndarray, b: np.ndarray, share: float, floor: int) -> bool:
    """Whether the union's sketch, made of both sketches, allows a resemblance of share.

    floor: how many values a whole sketch must share, least_shared().
    """
    both = np.sort(np.concatenate([a, b]))
    twice = both[1:] == both[:-1]
    union = both[np.append(True, ~twice)][:SKETCH]
    shared = int(np.searchsorted(both[1:][twice], union[-1], side="right"))
    need = math.ceil(share * len(union) - 1e-9) if len(union) < SKETCH else floor
    return shared >= need


def _forest(node: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Of the links (i, j) enough to connect what they connect."""
    parent = list(range(len(node)))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        x, y = top(a), top(b)
        if x != y:
            parent[x] = y
            out.append((int(min(node[a], node[b])), int(max(node[a], node[b]))))
    return out


def estimated(pairs: DataFrame, nodes: DataFrame, spec: NearSpec) -> DataFrame:
    """The pairs (leader, node) whose sizes, and the sketch of whose union, allow a link."""
    share, floor = spec.percent / 100, least_shared(SKETCH, spec.percent / 100, spec.miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = ([np.frombuffer(x, np.uint32) for x in batch.column(k).to_pylist()] for k in (2, 3))
            keep = pa.array([_estimate(a, b, share, floor) for a, b in zip(*sketches, strict=True)], pa.bool_())
            yield pa.record_batch([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["leader", "node"])

    one = nodes.select(F.col("node").alias("leader"), F.col("n").alias("a"), F.col("sketch").alias("x"))
    two = nodes.select("node", F.col("n").alias("b"), F.col("sketch").alias("y"))
    rows = pairs.join(one, "leader").join(two, "node").where(F.least("a", "b") >= share * F.greatest("a", "b"))
    return rows.select("leader", "node", "x", "y").mapInArrow(run, "leader long, node long")


def _sets(texts: pa.ChunkedArray, n: int) -> list[np.ndarray]:
    """The set of shingle hashes of each text, ascending."""
    out = []
    for _, _, data, offsets in text_chunks(texts):
        value, first = shingles(*word_hashes(data, offsets), n)
        out += [np.unique(value[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    return out


def star_links(pairs: DataFrame, texts: DataFrame, spec: NearSpec) -> DataFrame:
    """(src, dst): the pairs (leader, node) that are linked, by their whole sets.

    texts: (node, text).  The nodes of a leader are dealt out by STAR, or by their bytes, and
    its text goes along with each lot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_group(batches, ["leader", "lot"]):
            leader, node = table.column("leader")[0].as_py(), table.column("node").to_numpy()
            sets = _sets(table.column("text"), spec.n)
            heads = [sets[i] for i in np.flatnonzero(node == leader)]
            linked = []
            for x, own in zip(node.tolist(), sets, strict=True):
                if x != leader:
                    both = max((len(np.intersect1d(own, head, assume_unique=True)), -len(head)) for head in heads)
                    if 100 * both[0] >= spec.percent * (len(own) - both[1] - both[0]) and both[0]:
                        linked.append(x)
            yield pa.record_batch([pa.array([leader] * len(linked), pa.int64()), pa.array(linked, pa.int64())], names=["src", "dst"])

    sized = pairs.join(texts.select("node", F.octet_length("text").alias("size")), "node")
    lots = sized.groupBy("leader").agg(F.greatest(F.ceil(F.count("*") / STAR), F.ceil(F.sum("size") / BLOCK_BYTES)).alias("lots"))
    members = pairs.join(lots, "leader").select("leader", "node", F.pmod(F.xxhash64("node"), "lots").alias("lot"))
    heads = members.select("leader", F.col("leader").alias("node"), "lot").distinct()
    rows = members.union(heads).join(texts, "node").select("leader", "lot", "node", "text")
    return rows.repartition("leader", "lot").sortWithinPartitions("leader", "lot").mapInArrow(run, "src long, dst long")


KEYS = ["leader", "one", "two"]


def _may_differ(table: pa.Table) -> np.ndarray:
    """(n, n): whether two rows of a task are its work: of two components, and of its two blocks if it has two."""
    comp, block = table.column("component").to_numpy(), table.column("block").to_numpy()
    out = comp[:, None] != comp[None]
    if table.column("one")[0].as_py() != table.column("two")[0].as_py():
        out &= block[:, None] != block[None]  # a block against itself is another task's work
    return out


def plausible(groups: DataFrame, nodes: DataFrame, spec: NearSpec) -> DataFrame:
    """The (leader, node, component) of groups that have a partner there in another component,
    by the sketches of the unions.
    """
    share, floor = spec.percent / 100, least_shared(SKETCH, spec.percent / 100, spec.miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_group(batches, KEYS):
            node, size = table.column("node").to_numpy(), table.column("n").to_numpy()
            sketches = [np.frombuffer(x, np.uint32) for x in table.column("sketch").to_pylist()]
            row = np.repeat(np.arange(len(node)), [len(x) for x in sketches])
            used = np.bincount(row, minlength=len(node))
            shared = shared_counts(np.concatenate(sketches), row, len(node))
            # a bound: what both sketches share is at least what the sketch of the union does
            low = np.minimum(np.ceil(share * used - 1e-9), floor)
            fits = np.minimum(size[:, None], size[None]) >= share * np.maximum(size[:, None], size[None])
            close = fits & (shared >= np.maximum(low[:, None], low[None])) & _may_differ(table)
            keep = np.zeros(len(node), bool)
            for i in range(len(node)):
                if not keep[i]:
                    for j in np.flatnonzero(close[i]).tolist():
                        if _estimate(sketches[i], sketches[j], share, floor):
                            keep[i] = keep[j] = True
                            break
            yield pa.record_batch([table.column(k).combine_chunks().filter(pa.array(keep)) for k in ("leader", "node", "component")], names=["leader", "node", "component"])

    rows = groups.join(nodes.select("node", "n", "sketch"), "node")
    rows, homes = deal_blocks(rows, "leader", "node", "component", F.octet_length("sketch"), BLOCK, BLOCK_BYTES)
    out = stored(rows.repartition(*KEYS).sortWithinPartitions(*KEYS).mapInArrow(run, "leader long, node long, component long").distinct())
    discard(homes)
    return out


def exact_links(groups: DataFrame, texts: DataFrame, spec: NearSpec) -> DataFrame:
    """(src, dst) that connect the linked nodes of each group, by their whole sets.

    groups: (leader, node, component); nodes of one component are not compared.  texts:
    (node, text).  A text that several rows have under one node id is that many rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_group(batches, KEYS):
            node, work = table.column("node").to_numpy(), _may_differ(table)
            sets = _sets(table.column("text"), spec.n)
            size = np.asarray([len(x) for x in sets])
            flat, row = np.concatenate(sets), np.repeat(np.arange(len(size)), size)
            # a value that one node alone has is shared with nobody: without its values of
            # that kind a node must be large enough to be linked with some other
            _, where, df = np.unique(flat, return_inverse=True, return_counts=True)
            common = np.bincount(row, df[where] > 1, len(size))
            alive = (size > 0) & (100 * common >= spec.percent * size)
            keep = alive[row] & (df[where] > 1)
            number = np.cumsum(alive) - 1
            flat, row = flat[keep], number[row[keep]]
            node, size, work = node[alive], size[alive], work[alive][:, alive]
            out: list[tuple[int, int]] = []
            if len(node) > 1:
                shared = shared_counts(flat, row, len(node))
                i, j = np.nonzero(np.triu(work & (100 * shared >= spec.percent * (size[:, None] + size[None] - shared)), 1))
                out = _forest(node, i, j)
            yield pa.record_batch([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["src", "dst"])

    sized = groups.join(texts.select("node", F.octet_length("text").alias("size")), "node")
    dealt, homes = deal_blocks(sized, "leader", "node", "component", F.col("size"), BLOCK, BLOCK_BYTES)
    rows = dealt.join(texts, "node").select(*KEYS, "node", "component", "block", "text")
    out = stored(rows.repartition(*KEYS).sortWithinPartitions(*KEYS).mapInArrow(run, "src long, dst long"))
    discard(homes)
    return out


def texts_of(docs: DataFrame, nodes: DataFrame, text: str, key: str) -> DataFrame:
    """(node, text) of the rows of docs that have one of the nodes as key, stored.

    The nodes are stored and counted first: up to FETCH of them are broadcast, so that no text
    of another document is shuffled.
    """
    nodes = stored(nodes.distinct())
    few = nodes.count() <= FETCH
    texts = docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text"))
    out = stored(texts.join(F.broadcast(nodes) if few else nodes, "node", "left_semi"))
    discard(nodes)
    return out


def near_duplicates(docs: DataFrame, spec: NearSpec = NearSpec(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row per row of docs.

    Documents are linked if 100 * |A & B| >= percent * |A | B| for their sets of n-word
    shingles (A-Z folded; with fewer words the whole sequence is one shingle; without words
    the set is empty and linked with nothing).  component_id is the smallest doc_id
    reachable over links, kept says doc_id = component_id.

    Candidates come from bottom-k sketches, links are confirmed on the whole sets (of 64-bit
    shingle hashes).  A linked pair goes unseen with a chance of about spec.miss per filter,
    none for 0.

    Null texts are empty.  Rows with equal doc_id stand for one vertex where that id is
    their set's smallest, so all of them are in its component.  A null doc_id never names
    a component, except among rows that have no other: there component_id is null and
    kept false.  Very long texts are one numpy pass each.  No rows give no rows; other
    columns are not read.
    """
    slim = stored(sketch_documents(docs, spec, text, key))
    nodes = stored(
        slim.where("n_shingles > 0 and doc_id is not null")
        .groupBy("print")
        .agg(F.min("doc_id").alias("node"), F.max("n_shingles").alias("n"), F.max("low").alias("low"), F.max("sketch").alias("sketch"))
    )
    groups = stored(inverted_lists(nodes, spec))
    pairs = groups.where("leader <> node")
    pairs = stored(estimated(pairs, nodes, spec) if spec.miss else pairs)
    # texts are fetched only for nodes that the sketches leave
    texts = texts_of(docs, pairs.select("node").union(pairs.select(F.col("leader").alias("node"))), text, key)
    links = stored(star_links(pairs, texts, spec))
    one = stored(connected_components(links))
    placed = groups.join(one, "node", "left").select("leader", "node", F.coalesce("component", "node").alias("component"))
    placed = plausible(placed, nodes, spec) if spec.miss else stored(placed)
    rest = texts_of(docs, placed.select("node"), text, key)
    more = exact_links(placed, rest, spec)
    found = stored(connected_components(links.union(more)))
    discard(groups, pairs, texts, rest, links, one, placed, more)
    labels = nodes.select("print", "node").join(found, "node", "left").select("print", F.coalesce("component", "node").alias("component_id"))
    out = slim.select("doc_id", "n_shingles", "print").join(labels, "print", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    # a few numbers per document; the sketches they come from are large
    out = stored(out)
    discard(slim, nodes, found)
    return out
