"""Removal of repeated byte strings with a hash-compared suffix sort.

Every string of LENGTH bytes has an anchor, the smallest K-byte hash in it, so equal
strings meet at equal anchors.  Strings with one anchor that follow each other make a run.
Runs with equal prefix hashes need no sorting: once verified, all but the first are
repeats.  Where an anchor has different contexts, the strings around it are sorted as
suffixes: a bottom-up mergesort whose comparisons find the common extension by binary
search over prefix polynomial hashes; neighbours found equal are verified byte by byte.
Polynomial hashes only propose: inside a task the bytes are compared, across tasks 128-bit
BLAKE2 digests of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import discard, mix64, powers, stored, stored_by, text_chunks

#: Bytes of an anchor's hash.  A string of 100 bytes holds 61 of them.
K = 40
#: Texts are hashed in pieces of at most this many bytes, which overlap by a string less one.
PIECE = 1 << 20
#: Rows whose suffixes are sorted together at most, unless one anchor has more.
SORT_ROWS = 16_384
_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
_tables: dict[tuple[int, bool], np.ndarray] = {}


def _powers(n: int, which: int, inverse: bool) -> np.ndarray:
    """Powers of a base or of its inverse modulo 2 ** 64, kept per worker."""
    have = _tables.get((which, inverse))
    if have is None or len(have) < n:
        base = _BASES[which]
        have = powers(1 << max(20, int(n - 1).bit_length()), pow(base, -1, 1 << 64) if inverse else base)
        _tables[which, inverse] = have
    return have[:n]


class PrefixHashes:
    """Polynomial hash of any stretch of the bytes, from prefix sums."""

    def __init__(self, data: np.ndarray, which: int = 0):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(n, which, False), out=self.sums[1:])
        self.inverse = _powers(n + 1, which, True)

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.inverse[start]


def common_extension(hashes: PrefixHashes, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """How many of the next length bytes at a and b agree, by binary search over the hashes."""
    low = np.zeros(len(a), np.int64)
    high = np.full(len(a), length, np.int64)
    for _ in range(int(length).bit_length()):
        mid = (low + high + 1) >> 1
        same = hashes.of(a, mid) == hashes.of(b, mid)
        low = np.where(same, mid, low)
        high = np.where(same, high, mid - 1)
    return low


def suffix_order(data: np.ndarray, hashes: PrefixHashes, start: np.ndarray, segment: np.ndarray, length: int) -> np.ndarray:
    """Stable order of the strings data[start : start + length] within each segment.

    segment is ascending.  Bottom-up mergesort: at each level every string finds its place
    in the neighbouring run by binary search, all strings at once.
    """
    n = len(start)
    order = np.arange(n)
    if not n:
        return order
    begin = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
    size = np.diff(np.append(begin, n))
    first, many = np.repeat(begin, size), np.repeat(size, size)
    place = np.arange(n) - first
    width = 1
    while width < size.max():
        at = np.flatnonzero(many > width)
        base, count, mine = first[at], many[at], place[at]
        left = (mine // width) % 2 == 0
        run = mine // (2 * width) * (2 * width)
        low = np.minimum(np.where(left, run + width, run), count)
        stop = np.minimum(np.where(left, run + 2 * width, run + width), count)
        own = start[order[at]]
        begin_other, high = low.copy(), stop.copy()
        live = np.flatnonzero(low < high)
        while len(live):
            mid = (low[live] + high[live]) >> 1
            other = start[order[base[live] + mid]]
            x = own[live]
            same = common_extension(hashes, x, other, length)
            far = np.minimum(same, length - 1)
            above = data[x + far] > data[other + far]
            # equal strings keep their order: those of the left run stand first
            past = np.where(same == length, ~left[live], above)
            low[live] = np.where(past, mid + 1, low[live])
            high[live] = np.where(past, high[live], mid)
            live = live[low[live] < high[live]]
        offset = np.where(left, mine, mine - width) + (low - begin_other)
        moved = order[at]
        order[base + offset] = moved
        width *= 2
    return order


def repeats_in(contexts: list[bytes], anchor: np.ndarray, doc: np.ndarray, begin: np.ndarray, count: np.ndarray, offset: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of the strings that also start earlier in another string of their anchor.

    Row i has the strings begin[i] .. begin[i] + count[i] - 1 of document doc[i], whose bytes
    are contexts[i]; the anchor stands offset[i] bytes after the first one.
    """
    if len(contexts) > 2 * SORT_ROWS:
        # one anchor: strings in which it has different places never meet, so a few places
        # at a time keep the memory small
        found = []
        top = int(offset.max())
        for high in range(top, int((offset - count).min()), -4):
            skip = np.maximum(offset - high, 0)
            some = np.flatnonzero((skip < count) & (offset - skip > high - 4))
            if len(some):
                take = np.minimum(count[some] - skip[some], offset[some] - skip[some] - high + 4)
                parts = [contexts[i][a : a + n + length - 1] for i, a, n in zip(some.tolist(), skip[some].tolist(), take.tolist(), strict=True)]
                r, p = _repeats_in(parts, anchor[some], doc[some], begin[some] + skip[some], take, offset[some] - skip[some], length)
                found.append((some[r], p + skip[some][r]))
        return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])
    return _repeats_in(contexts, anchor, doc, begin, count, offset, length)


def _repeats_in(contexts: list[bytes], anchor: np.ndarray, doc: np.ndarray, begin: np.ndarray, count: np.ndarray, offset: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """repeats_in() for rows that fit into memory with all their strings."""
    sizes = np.asarray([len(x) for x in contexts], dtype=np.int64)
    data = np.frombuffer(b"".join(contexts), np.uint8)
    at = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    row = np.repeat(np.arange(len(contexts)), count)
    place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    # only strings in which the anchor has the same place can be equal
    _, group = np.unique(anchor, return_inverse=True)
    key = group[row] * (length + 1) + (offset[row] - place)
    by = np.lexsort((place, row, key))
    row, place, key = row[by], place[by], key[by]
    one = np.concatenate([[True], key[1:] != key[:-1]])
    alone = one & np.concatenate([one[1:], [True]])
    row, place, key = row[~alone], place[~alone], key[~alone]
    if not len(row):
        return row, place
    start = at[row] + place
    hashes = PrefixHashes(data)
    order = suffix_order(data, hashes, start, key, length)
    row, place, start = row[order], place[order], start[order]
    same = np.zeros(len(row), bool)
    close = np.flatnonzero(key[1:] == key[:-1]) + 1
    close = close[hashes.of(start[close], length) == hashes.of(start[close - 1], length)]
    for i in range(0, len(close), 65_536):  # collisions: compare the bytes themselves
        part = close[i : i + 65_536]
        step = np.arange(length)
        same[part] = (data[start[part][:, None] + step] == data[start[part - 1][:, None] + step]).all(axis=1)
    cls = np.cumsum(~same) - 1
    rank = np.lexsort((begin[row] + place, doc[row], cls))
    lead = rank[np.concatenate([[True], cls[rank][1:] != cls[rank][:-1]])]
    here = begin[row] + place
    first_doc, first_at = doc[row][lead][cls], here[lead][cls]
    later = (doc[row] > first_doc) | ((doc[row] == first_doc) & (here > first_at))
    return row[later], place[later]


#: Places count from here for the second text of a doc_id, from twice that for the third.
VARIANT = 1 << 40
#: An anchor with more different contexts than this is dealt out by single strings, whose
#: first occurrence is a grouped minimum.
HOT_ANCHOR = 32_768
#: What a text with very many copies is spread over when its copies look for the first.
SALTS = 16
RUN_SCHEMA = "h long, c long, doc long, begin long, strings int, lead int, known boolean"


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _runs_of(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(document number, h, c, begin, strings, lead) of the runs of a chunk of at most PIECE bytes."""
    n, span = len(data), length - K + 1
    if n < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64, np.int64))
    plain = PrefixHashes(data)
    grams = mix64(plain.of(np.arange(n - K + 1), K))
    # the position breaks ties to the left and comes along with the minimum
    low = (grams & ~np.uint64(PIECE - 1)) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
    anchor = (low & np.uint64(PIECE - 1)).astype(np.int64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    valid = doc[: len(anchor)] == doc[length - 1 : length - 1 + len(anchor)]
    fresh = valid.copy()
    fresh[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    begin = np.flatnonzero(fresh)
    group = np.cumsum(fresh)[valid]
    count = np.bincount(group, minlength=len(begin) + 1)[1:].astype(np.int64)
    lead = anchor[begin] - begin
    whole = PrefixHashes(data, 1).of(begin, count + length - 1)
    c = mix64(whole + (count * 4096 + lead).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return doc[begin], grams[anchor[begin]], c, begin, count, lead


def runs(docs: DataFrame, length: int) -> DataFrame:
    """RUN_SCHEMA rows of docs (doc, text, variant): each run of strings that share an anchor.

    Of equal runs in one chunk of texts only the first needs the other chunks; the rest are
    repeats, known as such.  Known runs that touch are one row, with a h of their own, so a
    text that repeats itself, or a chunk of texts with one passage, gives few rows.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            base = batch.column(2).to_numpy(zero_copy_only=False) * VARIANT
            for lo, _, data, offsets in text_chunks(batch.column(1), PIECE):
                if len(data) <= PIECE:
                    pieces = [(data, offsets, 0)]
                else:  # one long text
                    step = PIECE - length + 1
                    pieces = [(data[i : i + PIECE], np.asarray([0, len(data[i : i + PIECE])]), i) for i in range(0, len(data) - length + 1, step)]
                for part, at, shift in pieces:
                    row, h, c, begin, count, lead = _runs_of(part, at, length)
                    if not len(row):
                        continue
                    local = begin
                    doc, begin = ids[lo + row], begin - at[row] + shift + base[lo + row]
                    by = np.lexsort((begin, doc, c, h))
                    same = np.zeros(len(by), bool)
                    same[1:] = (h[by][1:] == h[by][:-1]) & (c[by][1:] == c[by][:-1])
                    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))
                    for i in np.flatnonzero(same).tolist():  # collisions: compare the bytes themselves
                        a, b, n = local[by[i]], local[by[first[i]]], count[by[i]] + length - 1
                        same[i] = n == count[by[first[i]]] + length - 1 and np.array_equal(part[a : a + n], part[b : b + n])
                    # the same place in rows with one id is no repeat
                    later = same & ((doc[by] != doc[by][first]) | (begin[by] != begin[by][first]))
                    known = np.zeros(len(by), bool)
                    known[by] = later
                    # known runs in their order: those that touch in one row become one
                    k = np.flatnonzero(known)
                    fresh = np.ones(len(k), bool)
                    fresh[1:] = (row[k][1:] != row[k][:-1]) | (begin[k][1:] > begin[k][:-1] + count[k][:-1] + length - 1)
                    head = k[fresh]
                    tail = k[np.append(fresh[1:], True)[: len(k)]]
                    span = begin[tail] + count[tail] - begin[head]
                    rest = np.flatnonzero(~known)
                    spread = mix64(h[head] + (doc[head] * 1_000_003 + begin[head]).astype(np.uint64))
                    yield pa.record_batch(
                        [
                            pa.array(np.concatenate([h[rest], spread]).view(np.int64)),
                            pa.array(np.concatenate([c[rest], c[head]]).view(np.int64)),
                            pa.array(np.concatenate([doc[rest], doc[head]])),
                            pa.array(np.concatenate([begin[rest], begin[head]])),
                            pa.array(np.concatenate([count[rest], span]).astype(np.int32)),
                            pa.array(np.concatenate([lead[rest], lead[head]]).astype(np.int32)),
                            pa.array(np.arange(len(rest) + len(head)) >= len(rest)),
                        ],
                        names=["h", "c", "doc", "begin", "strings", "lead", "known"],
                    )

    return docs.select("doc", "text", "variant").mapInArrow(find, RUN_SCHEMA)


SPAN_SCHEMA = "doc long, start long, end long"


CONTEXT_SCHEMA = "kind int, h long, c long, doc long, begin long, strings int, lead int, bytes binary"
#: Kinds of CONTEXT_SCHEMA rows: a context to sort, a single string, a run to verify.
SORT, SINGLE, VERIFY = 0, 1, 2


def contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """CONTEXT_SCHEMA rows of wanted (kind, h, c, doc, begin, strings, lead): bytes holds those
    of the run, or a digest of them where they are only compared.  A row of the kind SINGLE
    becomes a row per string.
    """
    wanted = wanted.withColumn("variant", F.expr(f"begin div {VARIANT}L"))
    rows = wanted.groupBy("doc", "variant").agg(F.collect_list(F.struct("kind", "h", "c", "begin", "strings", "lead")).alias("runs"))  # of one text
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    names = [c.split()[0] for c in CONTEXT_SCHEMA.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, wants = batch.column(0).to_pylist(), batch.column(1), batch.column(2)
            for i, doc in enumerate(ids):
                body = texts[i].cast(pa.binary()).as_py()
                out = []
                for want in wants[i].values.to_pylist():
                    kind, h, c, begin, strings, lead = (want[k] for k in ("kind", "h", "c", "begin", "strings", "lead"))
                    at = begin % VARIANT
                    part = body[at : at + strings + length - 1]
                    if kind == SINGLE:
                        out += [(kind, h, c, doc, begin + x, 1, 0, _digest(part[x : x + length])) for x in range(strings)]
                    else:
                        out.append((kind, h, c, doc, begin, strings, lead, part if kind == SORT else _digest(part)))
                yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return docs.join(rows, ["doc", "variant"]).select("doc", "text", "runs").mapInArrow(cut, CONTEXT_SCHEMA)


def later_of(rows: DataFrame, same: list[str], length: int) -> DataFrame:
    """SPAN_SCHEMA: the bytes of rows (doc, begin, strings) that are alike in the columns same but not the first.

    The first is a grouped minimum that is joined back, so very many equal rows are not one group.
    """
    firsts = rows.groupBy(*same).agg(F.min(F.struct("doc", "begin")).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = rows.join(firsts, same).where((F.col("doc") > F.col("first.doc")) | (F.col("begin") > F.col("first.begin")))
    return later.select("doc", F.col("begin").alias("start"), (F.col("begin") + F.col("strings") + length - 1).alias("end"))


def sorted_repeats(rows: DataFrame, length: int) -> DataFrame:
    """SPAN_SCHEMA: the bytes covered by strings of rows (of contexts()) that start earlier too."""

    def spans(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        h, doc, begin, strings, lead = (table.column(k).to_numpy() for k in ("h", "doc", "begin", "strings", "lead"))
        row, place = repeats_in(table.column("bytes").to_pylist(), h, doc, begin, strings.astype(np.int64), lead.astype(np.int64), length)
        by = np.lexsort((place, row))
        row, place = row[by], place[by]
        fresh = np.ones(len(row), bool)
        fresh[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)
        last = np.append(fresh[1:], True)[: len(row)]
        start = begin[row[fresh]] + place[fresh]
        end = begin[row[last]] + place[last] + length
        return pa.record_batch([pa.array(doc[row[fresh]]), pa.array(start), pa.array(end)], names=["doc", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                held.append(batch.slice(0, SORT_ROWS))
                batch = batch.slice(SORT_ROWS)
                if sum(x.num_rows for x in held) < SORT_ROWS:
                    continue
                table = pa.Table.from_batches(held)
                h = table.column("h").to_numpy()
                cut = int(np.flatnonzero(h != h[-1])[-1]) + 1 if h[0] != h[-1] else 0
                if cut:  # the last anchor may go on
                    yield spans(table.slice(0, cut))
                    held = table.slice(cut).to_batches()
        if held:
            yield spans(pa.Table.from_batches(held))

    rows = rows.select("h", "doc", "begin", "strings", "lead", "bytes")
    return rows.repartition("h").sortWithinPartitions("h").mapInArrow(run, SPAN_SCHEMA)


REST_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without overlap; spans that touch become one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def remove_repeats(docs: DataFrame, length: int = 100, text: str = "text", key: str = "doc_id", keep_bytes: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept), a row per row of docs.

    Removes each byte covered by a string of length bytes that also starts earlier: in a
    document of smaller doc_id, or in the same document at an earlier start.  Overlapping
    occurrences count, strings are judged on the input, matches do not cross documents.
    kept holds what is left (null unless keep_bytes; it need not be valid UTF-8).

    Null and empty texts have 0 bytes and lose nothing.  A null doc_id counts as the
    largest.  Copies of a row, doc_id and text, count as one document and do not remove each
    other; different texts of one doc_id come one after another, in the order of their MD5.
    A text of any length is hashed in pieces.  No rows give no rows; other columns are not
    read.  length must be over K = 40.
    """
    if length <= K:
        raise ValueError(f"strings of {K} bytes or fewer have no anchor")
    last = F.lit((1 << 63) - 1)
    base = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(key).cast("long"), last).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    base = base.withColumn("m", F.concat(F.md5("text"), F.sha1("text")))
    ids = stored(base.select("doc", "m", (F.octet_length("text") >= length).alias("long")))
    # further texts of one doc_id are told apart by number; as a rule there are none
    shared = ids.groupBy("doc").agg(F.min(F.xxhash64("m")).alias("lo"), F.max(F.xxhash64("m")).alias("hi")).where("lo <> hi").select("doc")
    others = ids.select("doc", "m").join(shared, "doc").distinct().withColumn("variant", F.row_number().over(W.partitionBy("doc").orderBy("m")).cast("long") - 1)
    others = stored(others.where("variant > 0"), small=True, shed=True)
    numbered = lambda rows: rows.join(others, ["doc", "m"], "left").withColumn("variant", F.coalesce("variant", F.lit(0)))
    # the texts are shuffled here, and nowhere else
    texts = stored_by(numbered(base).select("doc_id", "doc", "variant", "text"), "doc", "variant")
    # whole copies of an earlier text: every byte goes, and no other text needs them
    slim = numbered(ids.where("long"))
    firsts = slim.groupBy("m").agg(F.min("doc").alias("first"), F.count("*").alias("c")).where("c > 1")
    firsts = firsts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    copies = slim.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int")).join(firsts, ["m", "salt"]).where("doc <> first")
    copies = stored(copies.select("doc", "variant").distinct(), shed=True)
    discard(ids, others)
    by_context = W.partitionBy("h", "c").orderBy("doc", "begin")
    by_anchor = W.partitionBy("h")
    found = runs(texts.join(copies, ["doc", "variant"], "left_anti"), length).withColumns({"_n": F.row_number().over(by_context), "_more": F.lead("doc").over(by_context).isNotNull()})
    found = found.withColumns({"_lo": F.min("c").over(by_anchor), "_hi": F.max("c").over(by_anchor), "_c": F.count("*").over(by_anchor)})
    # of each class of runs the first is compared with other contexts of its anchor, and all with each other
    kinds = F.array_compact(
        F.array(
            F.when(~F.col("known") & (F.col("_n") == 1) & (F.col("_lo") != F.col("_hi")), F.when(F.col("_c") > HOT_ANCHOR, SINGLE).otherwise(SORT)),
            F.when(~F.col("known") & ((F.col("_n") > 1) | F.col("_more")), VERIFY),
        )
    )
    found = found.select("h", "c", "doc", "begin", "strings", "lead", "known", kinds.alias("kinds")).where("known or size(kinds) > 0")
    found = stored(found, shed=True)
    whole = found.where("known").select("doc", F.col("begin").alias("start"), (F.col("begin") + F.col("strings") + length - 1).alias("end"))
    wanted = found.where("not known").withColumn("kind", F.explode("kinds")).drop("known", "kinds")
    cut_out = stored(contexts(texts, wanted, length), shed=True)
    parts = sorted_repeats(cut_out.where(F.col("kind") == SORT), length)
    single = later_of(cut_out.where(F.col("kind") == SINGLE), ["bytes"], length)
    equal = later_of(cut_out.where(F.col("kind") == VERIFY), ["h", "c", "bytes"], length)
    parts = stored(parts.union(single).union(equal), shed=True)
    discard(cut_out)
    variant = F.expr(f"start div {VARIANT}L")
    places = [(F.col(k) - variant * VARIANT).alias(k) for k in ("start", "end")]
    all_of_it = copies.select("doc", (F.col("variant") * VARIANT).alias("start"), (F.col("variant") * VARIANT + VARIANT - 1).alias("end"))
    spans = whole.union(parts).union(all_of_it).groupBy("doc", variant.alias("variant")).agg(F.collect_list(F.struct(*places)).alias("spans"))  # of one document

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, body, gone in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
                cut = merge_spans([(x["start"], min(x["end"], len(body))) for x in gone or []])
                left, at = [], 0
                for start, end in cut:
                    left.append(body[at:start])
                    at = end
                rest = b"".join([*left, body[at:]])
                out.append((doc_id, len(body), len(body) - len(rest), len(cut), hashlib.sha256(rest).hexdigest(), rest if keep_bytes else None))
            names = [c.split()[0] for c in REST_SCHEMA.split(", ")]
            types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)] if out else [pa.array([], t) for t in types], names=names)

    marked = texts.join(spans, ["doc", "variant"], "left")
    return marked.select("doc_id", "text", "spans").mapInArrow(finish, REST_SCHEMA)
