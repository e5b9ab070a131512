"""Whole runs from a small relations table, and the HTTP service."""

import json
import random
import threading
import urllib.request
from urllib.error import HTTPError

from tessera.config import Settings
from tessera.operators.http import answer, serve
from tessera.operators.model import Matcher
from tessera.operators.serve import NameIndex, Service
from tessera.plans import jobs

SCHEMA = "record_id string, country string, party_type string, company_public_id string, company_name_norm string, party_public_id string, party_name string"


def test_runs(spark, tmp_path):
    rng = random.Random(5)
    part = lambda: "".join(rng.choice(["ка", "ро", "ми", "сте", "ван", "лу", "дор", "ши"]) for _ in range(rng.randint(2, 4)))
    surnames = [part() for _ in range(30)]
    people = [f"{rng.choice(surnames)} {part()} {part()}".title() for _ in range(300)]
    rows = []
    for i in range(500):
        name = people[i % 300]
        gold = f"g{i % 300}" if i % 300 < 40 else None
        rows.append((f"r{i}", ["arm", "kaz", "tjk"][(i + i // 300) % 3], "legal_entity" if i % 20 == 0 else "individual", f"c{i % 97}", f"ооо {name}", gold, name))
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "rel.parquet"))
    settings = Settings(str(tmp_path / "rel.parquet"), str(tmp_path / "work"))
    found = jobs.explore(spark, settings.data, settings.work)
    assert "entities" in found and found["columns"].count() == 7
    cross = jobs.cross_country(spark, settings)
    assert cross["gold"].first().entities == 40 and cross["persons"].first().found > 0
    tables = jobs.quality(spark, settings, 300, False, (300, 100, 100), 5)
    assert tables["model"].first().f1 > 0.8 and tables["names in train and test, left"].first().n == 0
    done = jobs.deduplicate(spark, settings, threshold=0.5)
    assert done["gold"].first().share > 0.9 and done["clusters"].first().clusters > 100
    assert spark.read.parquet(f"{settings.work}/deduplicated.parquet").count() == 500
    report = [r.value for r in spark.read.text(f"{settings.work}/dedup_report").collect()]
    assert "## clusters" in report

    service = Service(Matcher.load(f"{settings.work}/matcher"), NameIndex.build(spark.createDataFrame([(x,) for x in people], "name string")))
    server = serve(spark, service, 0, "127.0.0.1")
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"

    def post(path, body):
        with urllib.request.urlopen(urllib.request.Request(url + path, json.dumps(body).encode(), method="POST")) as r:
            return json.loads(r.read())

    with urllib.request.urlopen(url + "/health") as r:
        assert json.loads(r.read())["index_size"] == len(set(people))
    hit = post("/search", {"name": people[0], "top_k": 3})
    assert people[0] in [x["name"] for x in hit["results"]] and hit["candidates_examined"] >= 1
    assert post("/check_duplicate?threshold=0.5", {"left": people[0], "right": people[0].upper()})["threshold"] == 0.5
    assert post("/deduplicate_batch", {"names": [people[0], people[1], people[0].upper()], "threshold": 0.5})["cluster_ids"][0] == 0
    for path, body, code in (("/search", {"name": "x", "top_k": 0}, 422), ("/search", {}, 422), ("/nothing", {}, 404)):
        try:
            post(path, body)
        except HTTPError as e:
            assert e.code == code
        else:
            raise AssertionError(path)
    server.shutdown()
    assert answer(spark, Service(), "/check_duplicate", {}, {"left": "a", "right": "b"})[0] == 503
