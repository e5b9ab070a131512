"""WARC bundles (1), mixing (2), packing (8)."""

import base64
import hashlib
import io
import itertools
import random

import numpy as np
import zstandard
from cases import frame, rows, words

from tessera.llm import mixing, packing, warc


def test_warc_round_trip(spark, tmp_path):
    big = "<p>" + "é" * 300_000
    data = [(5, "u5", "same"), (2, "u2", "same"), (9, None, ""), (7, "u\r\n7 %41", None), (1, "u1", big), (8, "u8", "x\r\n\r\ny"), (2, "u2", "same"), (3, "u3", "WARC/1.1\r\n\r\n")]
    df = spark.createDataFrame([(*x, 1, "k") for x in data], "page_id long, url string, html string, record_key int, _digest string").repartition(3)
    index = warc.write_warc(df, str(tmp_path / "a"), frame_bytes=200)
    got = sorted(((int(r.record_key), r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, r.target_uri) for r in warc.read_warc(index).collect()), key=repr)
    first = {}
    for k, _, html in data:
        first[html or ""] = min(first.get(html or "", k), k)
    wanted = []
    for k, url, html in data:
        body = (html or "").encode()
        old = first[html or ""] != k
        wanted.append((k, "revisit" if old else "response", str(first[html or ""]) if old else None, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), url))
    assert got == sorted(wanted, key=repr)
    payload = {r.record_key: bytes(r.payload) for r in warc.read_warc(index).where("payload is not null").collect()}
    assert payload["1"] == big.encode() and payload["8"] == b"x\r\n\r\ny"
    (record,) = warc.fetch(index, "1")
    assert record[1] == "response" and record[-1] == big.encode()
    # a bundle is plain Zstandard too: frames one after another and a skippable one
    path = index.first().bundle
    with open(path, "rb") as f:
        body = f.read()
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(body), read_across_frames=True).read()
    table = warc.seek_table(warc.open_fs(path)[0].open_input_file(path))
    assert sum(x[1] for x in table) < len(body) and sum(x[2] for x in table) == len(whole)
    assert whole.startswith(b"WARC/1.1") and len(list(warc.parse_records(whole))) == sum(r.bundle == path for r in index.collect())


def test_warc_threshold_and_empty(spark, tmp_path):
    df = spark.createDataFrame([(1, "", "aa"), (2, "", "aa"), (3, "", ""), (4, "", "")], "page_id long, url string, html string")
    kinds = {int(r.record_key): r.record_type for r in warc.read_warc(warc.write_warc(df, str(tmp_path / "b"), min_revisit_bytes=2)).collect()}
    assert kinds == {1: "response", 2: "revisit", 3: "response", 4: "response"}
    assert warc.read_warc(warc.write_warc(df.limit(0), str(tmp_path / "c"))).count() == 0


def test_targets():
    spec = mixing.MixSpec()
    assert mixing.targets([100, 100, 100], spec) == [200.0, 500 / 3, 250 / 3]  # 450 in all: 5 wants more than twice its size
    t = mixing.targets([10, 1_000, 30, 500], spec)
    assert abs(sum(t) - 1.5 * 1_540) < 1e-6 and all(a <= 2 * b + 1e-9 for a, b in zip(t, [10, 1_000, 30, 500]))
    assert mixing.targets([], spec) == [] and mixing.targets([0, 5], spec)[0] == 0


def test_mix(spark):
    data = rows(21)
    df = frame(spark, data)
    mixed = mixing.mix(df)
    got = mixed.collect()
    assert sorted((r.doc_id, r["size"]) for r in got) == sorted((d, len(words(t))) for d, t, *_ in data)
    sizes = {}
    for _, t, _, s, _ in data:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = dict(zip(order, mixing.targets([sizes[s] for s in order], mixing.MixSpec())))
    taken = {}
    for r in got:
        assert r.taken <= 2 * r["size"] and r.taken == sum(c.words for c in r.copies)
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 3  # repeated rows share the cut
    again = mixing.mix(df.repartition(7)).collect()
    key = lambda r: (r.doc_id, r["size"], r.taken, r.copies)
    assert sorted(map(key, got), key=repr) == sorted(map(key, again), key=repr)
    flat = mixing.materialise(mixed).select("doc_id", "text", "pass", "shard").collect()
    assert sum(len(words(r.text)) for r in flat) == sum(taken.values())
    originals = {}
    for d, t, *_ in data:
        originals.setdefault(d, []).append(t)
    assert all(any(t and t.startswith(r.text) for t in originals[r.doc_id]) for r in flat)
    assert mixing.mix(df.limit(0)).count() == 0


def test_mix_is_shuffled_over_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, "a b c d", f"s{i % 2}") for i in range(4_000)], "doc_id long, text string, source string")
    mixed = mixing.mix(df, mixing.MixSpec(blocks=256, shards=4, weights=(1.0, 1.0)))
    n = {(r.shard, r.source): r["count"] for r in mixing.materialise(mixed).groupBy("shard", "source").count().collect()}
    assert set(n) == set(itertools.product(range(4), ["s0", "s1"])) and max(n.values()) < 1.6 * min(n.values())
    mixing.write_shards(mixed, str(tmp_path / "mix"))
    assert spark.read.parquet(str(tmp_path / "mix")).count() == 6_000


def test_query_and_stage_follow_the_tree(spark):
    import corpus_pipeline as cp
    from tessera.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    mixed = mixing.mix(docs)
    places = {r.doc_id: ([c.shard for c in r.copies], [c.order for c in r.copies], r.taken) for r in mixed.collect()}
    got = QUERIES["op2_mixing"](spark, sf).collect()
    assert {r.doc_id: (r.shards, r.orders, r.taken) for r in got} == places
    assert {s for r in got for s in r.shards} == set(range(16)) and sum(r.taken for r in got) > 0
    rows = sorted(mixing.materialise(mixed).collect(), key=lambda r: (r.shard, r.order))
    want = [(r.doc_id, r.text) for r in rows]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (old, "200"):  # a partition per shard, and several
            spark.conf.set("spark.sql.shuffle.partitions", n)
            stage = cp.mixture(spark, docs, sf)
            assert stage.columns == docs.columns and [(r.doc_id, r.text) for r in stage.collect()] == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_splitting_tree_is_exact():
    counts = np.asarray([1_000, 37, 0, 512])
    left = mixing.splitting_tree(counts, 8, 3)
    leaves = []

    def walk(node, have):
        if node >= 8:
            leaves.append(have)
        else:
            assert (left[:, node] <= have).all()
            walk(2 * node, left[:, node])
            walk(2 * node + 1, have - left[:, node])

    walk(1, counts)
    assert (np.sum(leaves, axis=0) == counts).all() and max(map(sum, leaves)) - min(map(sum, leaves)) <= 1


def test_best_buckets():
    rng = random.Random(22)
    for _ in range(30):
        lengths = sorted(rng.sample(range(1, 60), rng.randint(1, 8)))
        n = np.asarray([rng.randint(1, 9) for _ in lengths])
        longest = np.asarray(lengths)
        k = rng.randint(1, 5)
        cost = lambda ends: sum(int(longest[e]) * int(n[a : e + 1].sum()) - int((longest * n)[a : e + 1].sum()) for a, e in zip([0, *[x + 1 for x in ends[:-1]]], ends))  # noqa: E731,B023
        last = len(lengths) - 1
        best = min(cost([*c, last]) for r in range(min(k, len(lengths))) for c in itertools.combinations(range(last), r))
        got = packing.best_buckets(longest, n, longest * n, k)
        assert len(got) <= k and got[-1] == last and cost(got) == best


def test_pack(spark):
    data = rows(23)
    spec = packing.PackSpec(buckets=4, budget=500, exact=16, fine=8, group=16)
    got = packing.pack(frame(spark, data), spec).collect()
    assert sorted((r.doc_id, r.length) for r in got) == sorted((d, len(words(t))) for d, t, *_ in data)
    batches = {}
    for r in got:
        assert r.length <= r.padded_length
        batches.setdefault((r.bucket, r.batch_group, r.batch), []).append(r)
    for members in batches.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
        assert len(members) * members[0].padded_length <= 500 or len(members) == 1
    assert len({r.bucket for r in got}) <= 4
    assert packing.pack(frame(spark, data).limit(0)).count() == 0


def test_length_bins_keep_order(spark):
    spec = packing.PackSpec(exact=16, fine=8)
    df = spark.range(5_000).select("id", packing.length_bin(packing.F.col("id"), spec).alias("b")).orderBy("id").collect()
    assert all(x.b <= y.b for x, y in zip(df, df[1:])) and [r.b for r in df[:17]] == list(range(17))
