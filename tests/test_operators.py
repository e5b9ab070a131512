"""Blocking, components, deduplication, training, profiling, sources and service."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.config import Columns, Settings
from tessera.operators import blocking, dedup, evaluate, profile, training
from tessera.operators.graph import connected_components
from tessera.operators.model import Matcher, featured, train
from tessera.operators.serve import BadRequest, NameIndex, NotReady, Service
from tessera.sources import io


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(5, 5), (None, 3), (1_000, 1_001)] + [(2_000 + i, 2_001 + i) for i in range(200)] + [(5_000, 6_000 + i) for i in range(50)]
    label = {}

    def top(x):
        label.setdefault(x, x)
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        if a is not None:
            x, y = top(a), top(b)
            label[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {x: top(x) for x in label}
    assert connected_components(df.limit(0)).count() == 0


def test_blocks(spark):
    names = spark.createDataFrame([(i, f"same w{i:03d}", "P") for i in range(61)] + [(100, "b a", "X"), (101, "a b", "X"), (102, "", "")], "name_id long, lat string, phon string")
    keys = blocking.blocking_keys(names, soundex=True)
    assert keys.where("name_id = 102").count() == 0
    pairs = {(r.src, r.dst) for r in blocking.candidate_pairs(keys.where("key_type = 'phon'")).collect()}
    assert pairs == {(100, 101)}  # 61 names share the other key
    assert blocking.candidate_pairs(keys.where("key_type = 'phon'"), 61).count() == 61 * 60 // 2 + 1
    everything = [(r.src, r.dst) for r in blocking.candidate_pairs(keys).collect()]
    assert len(everything) == len(set(everything)) and all(a < b for a, b in everything)


RELATIONS = "record_id string, country string, party_type string, company_public_id string, party_public_id string, party_name string"


def relations(spark):
    names = ["Иванов Пётр", "Ivanov Petr", "Petr Ivanov", "Ғабдуллин Қанат", "Gabdullin Kanat", "--", None, "Сидоров Олег", "Sidorov Oleg", "Общий Директор"]
    rows = [(f"r{i}", "kaz" if i % 2 else "arm", "individual", f"c{i}", f"g{i // 2}" if i < 4 else None, n) for i, n in enumerate(names)]
    rows += [(f"s{i}", "tjk", "individual", f"d{i}", None, "Общий Директор") for i in range(60)]
    return spark.createDataFrame(rows, RELATIONS)


def by_rule(pairs, names):
    from tessera.functions.similarity import levenshtein_score
    from tessera.functions.text import sorted_tokens

    side = lambda k, n: names.select(F.col("name_id").alias(k), F.col("lat").alias(n))
    return pairs.join(side("src", "l"), "src").join(side("dst", "r"), "dst").select("src", "dst", levenshtein_score(sorted_tokens("l"), sorted_tokens("r")).alias("score"))


def test_deduplicate(spark, tmp_path):
    done = dedup.deduplicate(relations(spark), by_rule, threshold=0.9)
    cluster = {r.record_id: r.cluster_id for r in done.rows.collect()}
    assert cluster["r0"] == cluster["r1"] == cluster["r2"] != cluster["r3"] and cluster["r3"] == cluster["r4"]
    assert cluster["r5"] == cluster["r6"] == cluster["r9"] == cluster["s3"] == -1 and cluster["r7"] == cluster["r8"]
    auto = dedup.deduplicate(relations(spark), by_rule)
    sweep = auto.sweep.orderBy("threshold").collect()
    assert [r.threshold for r in sweep] == [0.5, 0.7, 0.9, 0.95, 0.98, 0.99]
    assert all(a.clusters <= b.clusters and a.edges >= b.edges for a, b in zip(sweep, sweep[1:]))
    report = dedup.cluster_report(done.rows).first()
    assert (report.clusters, report.records_in_groups, report.multi_country) == (3, 7, 3)
    gold = dedup.gold_recall(done.rows, "party_public_id").first()
    assert (gold.entities, gold.whole, gold.whole_resolved) == (2, 1, 1)
    assert dedup.cross_country(done.rows).first().n == 3 and dedup.cross_country(done.rows, include_unresolved=True).first().n == 4
    dedup.export(done.rows, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).columns == ["record_id", "country", "party_type", "cluster_id"]


def test_report_of_nothing_resolved(spark):
    rows = spark.createDataFrame([(-1, "a"), (-1, "b")], "cluster_id long, country string")
    assert tuple(dedup.cluster_report(rows).first()) == (0, 0, None, None, None, None, None, None, 0)


def test_sweep_choice(spark):
    sweep = spark.createDataFrame([(0.5, 10), (0.7, 6), (0.9, 2)], "threshold double, cross_country long")
    assert dedup.choose_threshold(sweep, 4) == 0.7 and dedup.choose_threshold(sweep, 8) == 0.5 and dedup.choose_threshold(sweep, 0) == 0.9


@pytest.fixture(scope="module")
def pairs(spark):
    rng = random.Random(4)
    part = lambda: "".join(rng.choice(["ka", "ro", "mi", "ste", "van", "lu", "dor", "shi"]) for _ in range(rng.randint(2, 4)))
    surnames = [part() for _ in range(60)]
    names = [(f"{rng.choice(surnames)} {part()} {part()}",) for _ in range(900)]
    df = spark.createDataFrame(names, "name string")
    return training.split_by_entity(training.training_pairs(df, 500, 200, 150)).cache()


def test_training_pairs(spark, pairs):
    kinds = {r.kind: r["count"] for r in pairs.groupBy("kind").count().collect()}
    assert kinds[training.NAMESAKE] <= 200 and kinds[training.RANDOM] == 150 and 400 < kinds[training.POSITIVE] <= 500
    assert pairs.where("label = 1 and n_ops not in (1, 2, 3) or label = 0 and n_ops <> 0").count() == 0
    assert training.leakage(pairs).first().n == 0
    test = {r.kind: r["count"] for r in pairs.where("split = 'test'").groupBy("kind").count().collect()}
    assert all(test[k] > 0.05 * kinds[k] for k in kinds)  # every kind is in the test split
    shares = {r.split: r["count"] for r in pairs.select("left", "split").distinct().groupBy("split").count().collect()}
    n = sum(shares.values())
    assert shares["train"] == int(n * 0.7) and abs(shares["valid"] - 0.15 * n) <= 1
    groups = training.namesake_groups(pairs.select(F.col("left").alias("lat")))
    assert groups.groupBy("surname").count().agg(F.max("count")).first()[0] <= 8


def test_split_shares_are_exact(spark):
    # 90 * 0.7 is 62.99... as a double
    split = training.split_by_entity(spark.range(90).select(F.col("id").cast("string").alias("left")))
    assert {r.split: r["count"] for r in split.groupBy("split").count().collect()} == {"train": 63, "valid": 13, "test": 14}


def test_model(spark, pairs, tmp_path):
    rows = featured(pairs).cache()
    matcher = train(rows, rounds=10)
    scored = matcher.predict(rows.where("split = 'test'"), "score").select("label", "score", "kind").cache()
    assert evaluate.roc_auc(scored).first().auc > 0.95
    assert evaluate.at_thresholds(scored, [0.5]).first().f1 > 0.85
    assert evaluate.best_f1_threshold(scored).first().threshold >= 0.5
    assert sum(evaluate.confusion(scored).first()) == scored.count()
    assert evaluate.slice_accuracy(scored, "kind").count() == evaluate.group_counts(scored, "label", "kind").count() >= 2
    assert matcher.predict(rows.limit(0)).count() == 0
    assert len(matcher.importances()) == 11 and matcher.importances()[0][1] >= matcher.importances()[-1][1]
    matcher.save(str(tmp_path / "model"))
    again = Matcher.load(str(tmp_path / "model"))
    assert again.predict(rows, "score").select("score").subtract(matcher.predict(rows, "score").select("score")).count() == 0

    service = Service(again)
    assert service.health() == {"status": "ok", "model_loaded": True, "index_size": 0}
    with pytest.raises(NotReady):
        Service().check_duplicate(spark, "a", "b")
    with pytest.raises(NotReady):
        service.search(spark.createDataFrame([("x",)], "query string"))
    answer = service.check_duplicate(spark, "Қанат Ғабдуллин", "Gabdullin Kanat")
    assert answer["left_normalized"] == "kanat gabdullin" and answer["threshold"] == 0.9 and 0 <= answer["probability"] <= 1
    names = spark.createDataFrame([("Stevan Karo",), ("Karo Stevan",), ("Lumi Dorshi",), (None,)], "name string")
    service.index = NameIndex.build(names)
    assert service.health()["index_size"] == 3
    found = service.search(spark.createDataFrame([("karo stevan",), ("nobody here",)], "query string"), 1).collect()
    assert [(r.query, r["rank"], r.candidates) for r in found] == [("karo stevan", 1, 2)]
    with pytest.raises(BadRequest):
        service.search(names.select(F.col("name").alias("query")), 0)
    batch = spark.createDataFrame([(0, "Stevan Karo"), (1, "Lumi Dorshi"), (2, "stevan karo"), (3, "")], "position long, name string")
    ids = {r.position: r.cluster_id for r in service.deduplicate_batch(batch, 0.0).collect()}
    assert ids[0] == ids[2] == 0 and ids[1] == 1 and ids[3] == 2
    with pytest.raises(BadRequest):
        service.deduplicate_batch(batch, limit=3)


def test_evaluation_edges(spark):
    empty = spark.createDataFrame([], "label int, score double, g string")
    assert evaluate.roc_auc(empty).first().auc is None and evaluate.confusion(empty).first().tp == 0
    tied = spark.createDataFrame([(1, 0.5, "a"), (0, 0.5, "a"), (1, 0.9, "b"), (0, 0.1, "b")], "label int, score double, g string")
    assert evaluate.roc_auc(tied).first().auc == 0.875
    assert evaluate.by_group(tied, "g", min_positives=2).count() == 0 and evaluate.by_group(tied, "g", min_positives=1).count() == 2


def test_profile(spark):
    rows = [(i, f"id{i}", f"name of {i % 50}", "a" if i % 3 else None, f"p{i // 4}" if i < 40 else None, {"k": i}) for i in range(200)]
    df = spark.createDataFrame(rows, "n int, code string, party_name string, country string, party_public_id string, m map<string,int>")
    found = {r.column: r for r in profile.profile_columns(df).collect()}
    assert found["country"].null_share == 0.335 and found["m"].n_distinct == -1 and found["code"].n_distinct == 200
    assert profile.low_cardinality(df) == ["party_name", "country", "party_public_id"]
    assert profile.pick_text_columns(df) == ["party_name"] and profile.looks_like_id(df, "code") and profile.looks_like_id(df.limit(0), "code")
    assert profile.find_gold(df) == "party_public_id" and profile.roles(df) == {"name": "party_name", "country": "country"}
    assert profile.value_counts(df, "country", 1).first().n == 133
    report = profile.explore(df)
    assert {"columns", "low_cardinality", "text:party_name", "entities", "sizes", "difficulty", "skew"} <= set(report)
    assert all(x.count() >= 0 for x in report.values())


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([(i, f"n{i}") for i in range(50)], "id long, party_name string")
    io.write_parquet(df, str(tmp_path / "a.parquet"))
    io.write_csv(df, str(tmp_path / "b.csv"))
    assert io.read_table(spark, str(tmp_path / "a.parquet"), ["id"]).columns == ["id"]
    assert io.read_table(spark, str(tmp_path / "b.csv"), rows=7).count() == 7
    assert dict(io.read_table(spark, str(tmp_path / "b.csv")).dtypes)["id"] == "int"
    one = {r.id for r in io.sample_exact(df, 10, 42, ["id"]).collect()}
    assert len(one) == 10 and one == {r.id for r in io.sample_exact(df.repartition(7), 10, 42, ["id"]).collect()}
    with pytest.raises(ValueError, match="fewer"):
        io.sample_exact(df, 51, 42, ["id"], strict=True)
    assert io.file_megabytes(spark, str(tmp_path / "a.parquet")) > 0
    io.write_report(spark, ["one", "two"], str(tmp_path / "r"))
    assert [r.value for r in spark.read.text(str(tmp_path / "r")).collect()] == ["one", "two"]
    assert io.read_names(spark, str(tmp_path / "a.parquet")).count() == 50 and io.read_names(spark, str(tmp_path / "a.parquet"), "other").count() == 50


def test_settings(monkeypatch):
    monkeypatch.setenv("ER_DATA", "x.parquet")
    assert Settings.from_env().data == "x.parquet" and Settings().columns == Columns()
