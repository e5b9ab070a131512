"""Repeated substrings (5) and near duplicates (6)."""

import random

import numpy as np
from cases import frame, near_components, removed_repeats, rows

import tessera.llm.near_dedup as nd
import tessera.llm.substring_dedup as sd


def found_repeats(df, length):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.remove_repeats(df, length).collect())


def test_substrings(spark):
    data = rows(11)
    assert found_repeats(frame(spark, data), 100) == removed_repeats(data, 100)
    assert found_repeats(frame(spark, data).limit(0), 100) == []


def test_substrings_shuffle_texts_once(spark):
    """What is found is joined to the texts where they lie."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sd.remove_repeats(frame(spark, rows(11)), 100)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = next(x for x in plan.split("\n") if "FileScan" in x and "text#" in x)
    assert "Bucketed: true" in scan and plan.count("Exchange") == 1


def test_substrings_of_periodic_and_null_rows(spark):
    data = [(0, "ab" * 300, "", "", 0), (1, "ba" * 250 + "x", "", "", 0), (2, "a" * 400, "", "", 0), (3, "b" + "a" * 120, "", "", 0), (3, "a" * 99, "", "", 0)]
    assert found_repeats(frame(spark, data), 100) == removed_repeats(data, 100)
    one = spark.createDataFrame([(None, "x" * 150), (4, "x" * 120)], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in sd.remove_repeats(one, 100).collect()}
    assert got == {None: (150, 1), 4: (119, 1)}


def test_substrings_long_text_in_pieces(spark, monkeypatch):
    """A text over several hash pieces, and an anchor that counts as hot."""
    rng = random.Random(12)
    long = "".join(rng.choice("abcdefgh ") for _ in range(6_000))
    data = [(0, long, "", "", 0), (1, "zz" + long[2_000:2_300] + "yy" + long[100:260], "", "", 0), (2, long[:3_000] + "q" + long[3_001:], "", "", 0)]
    monkeypatch.setattr(sd, "PIECE", 1_024)
    monkeypatch.setattr(sd, "HOT_ANCHOR", 1)
    assert found_repeats(frame(spark, data), 100) == removed_repeats(data, 100)


def test_substrings_verify_what_hashes_propose(spark, monkeypatch):
    """Hashes that make any two runs of one anchor look equal remove nothing that differs."""
    same = sd._runs_of

    def careless(data, offsets, length):
        row, h, c, begin, count, lead = same(data, offsets, length)
        return row, h, np.full_like(c, 7), begin, count, lead

    monkeypatch.setattr(sd, "_runs_of", careless)
    middle = "the very same forty bytes or some more of them here " * 2
    data = [(i, f"{i}" * 60 + middle + f"{chr(97 + i)}" * 60, "", "", 0) for i in range(6)]
    got = {r.doc_id: r.n_removed for r in sd.remove_repeats(frame(spark, data), 100).collect()}
    wanted = {d: n for d, _, n, _, _ in removed_repeats(data, 100)}
    assert all(got[d] <= wanted[d] for d in got) and wanted[5] > 0


def test_suffix_order():
    rng = random.Random(13)
    data = np.frombuffer(bytes(rng.choice(b"ab") for _ in range(900)), np.uint8)
    start = np.asarray([rng.randrange(0, 860) for _ in range(200)])
    segment = np.sort(np.asarray([rng.randrange(5) for _ in range(200)]))
    order = sd.suffix_order(data, sd.PrefixHashes(data), start, segment, 40)
    strings = [(s, data[x : x + 40].tobytes()) for s, x in zip(segment, start)]
    assert [strings[i] for i in order] == sorted(strings)


def test_large_group_equals_small(monkeypatch):
    rng = random.Random(14)
    parts = [bytes(rng.choice(b"ab") for _ in range(6)) + b"x" * 40 + bytes(rng.choice(b"ab") for _ in range(6)) for _ in range(50)]
    args = (parts, np.zeros(50, np.int64), np.arange(50), np.zeros(50, np.int64), np.full(50, 5), np.full(50, 6), 48)
    small = set(zip(*map(np.ndarray.tolist, sd.repeats_in(*args))))
    monkeypatch.setattr(sd, "SORT_ROWS", 4)
    assert set(zip(*map(np.ndarray.tolist, sd.repeats_in(*args)))) == small and small


def found_components(df, n, percent):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in nd.near_duplicates(df, nd.NearSpec(n, percent)).collect())


def test_near_duplicates(spark):
    for n, percent in ((3, 85), (5, 80)):
        data = rows(15)
        assert found_components(frame(spark, data), n, percent) == near_components(data, n, percent)
    assert found_components(frame(spark, data).limit(0), 3, 85) == []


def test_near_duplicates_in_blocks(spark, monkeypatch):
    """A cloud of near copies dealt out as pairs of blocks, chained links and unlinked ones."""
    monkeypatch.setattr(nd, "BLOCK", 8)
    rng = random.Random(16)
    base = [f"w{rng.randrange(10_000)}" for _ in range(300)]
    data = []
    for i in range(60):
        text = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 8, 16])):
            text[rng.randrange(300)] = f"n{rng.randrange(10**6)}"
        data.append((i, " ".join(text), "", "", 0))
    wanted = near_components(data, 3, 85)
    assert found_components(frame(spark, data), 3, 85) == wanted
    monkeypatch.setattr(nd, "BLOCK_BYTES", 8_000)
    monkeypatch.setattr(nd, "STAR", 4)
    assert found_components(frame(spark, data), 3, 85) == wanted


def test_near_duplicates_texts_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(nd, "FETCH", 0)
    data = rows(17)
    assert found_components(frame(spark, data), 3, 85) == near_components(data, 3, 85)


def test_near_duplicates_exact(spark):
    """Nothing is estimated: whole sets make the lists."""
    data = rows(17)
    got = nd.near_duplicates(frame(spark, data), nd.NearSpec(3, 85, miss=0)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == near_components(data, 3, 85)


def test_near_duplicates_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(None, text), (3, text), (None, "alone here"), (5, None)], "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in nd.near_duplicates(df, nd.NearSpec(3, 85)).collect()}
    assert got == {(None, 38): (3, False), (3, 38): (3, True), (None, 1): (None, False), (5, 0): (5, True)}


def test_thresholds_are_safe():
    assert nd.least_shared(32, 0.85, nd.MISS) == 15 and nd.least_shared(128, 0.8, nd.MISS) < 0.8 * 128
    a, b = (np.arange(k, k + 128, dtype=np.uint32) for k in (0, 10))
    floor = nd.least_shared(128, 0.8, nd.MISS)
    assert nd._estimate(a, b, 0.8, floor) and not nd._estimate(a, np.arange(100, 228, dtype=np.uint32), 0.8, floor)
