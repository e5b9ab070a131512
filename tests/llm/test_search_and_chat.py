"""Vector search (9) and chat formatting (3)."""

import json
import random
from collections import Counter

import numpy as np
from cases import frame, near_components, rows

from tessera.llm import ann
from tessera.llm import chat_format as cf


def brute(data, k=20):
    good = {i: np.asarray(v, float) for i, v in data if i is not None and v and None not in v and np.isfinite(np.asarray(v, float)).all() and any(v)}
    out = {}
    for q, x in good.items():
        if q % 20 == 0:
            scored = sorted(((-float(x @ y), i) for i, y in good.items() if i != q))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_search_recall(spark):
    rng = np.random.default_rng(31)
    centres = rng.standard_normal((20, 24))
    data = [(i, (centres[i % 20] + 0.5 * rng.standard_normal(24)).astype(np.float32).tolist()) for i in range(3_000)]
    data += [(3_000 + i, data[7][1]) for i in range(200)]  # many copies of one vector
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(5)
    got = {}
    # the exact products of 2 % of a block only, so that the codes decide
    for r in ann.search(df, ann.AnnSpec(row_block=1_600, rerank=32)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute(data)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9
    for q, found in got.items():
        exact = dict((i, np.dot(np.asarray(data[q][1] if q < 3_000 else data[7][1], float), np.asarray(dict(data)[i], float))) for i, _ in found)
        assert all(abs(s - exact[i]) < 1e-9 for i, s in found)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_search_recall_on_the_table(spark):
    """Recall through the codes on the largest table at hand: 2 % of the rows reranked."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    want = brute(rows)
    got = {}
    for r in ann.search(df, ann.AnnSpec(rerank=len(rows) // 50)).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    recall = sum(len(got[q] & {i for i, _ in want[q]}) for q in want) / sum(map(len, want.values()))
    assert recall >= 0.95


def test_search_awkward_rows(spark):
    data = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, []), (8, [1.0]), (None, [9.0, 9.0]), (40, [float("inf"), 0.0])]
    df = spark.createDataFrame([(*x, 1, 2) for x in data], "vec_id long, embedding array<double>, score int, id int")
    got = {}
    for r in ann.search(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert got == {0: [(1, 1, 1.0), (2, 2, 1.0), (3, 20, 0.5)], 20: [(1, 1, 1.0), (2, 2, 1.0), (3, 0, 0.5)]}
    assert ann.search(df.limit(0)).count() == 0


def test_anisotropic_codes_favour_the_parallel_part():
    rng = np.random.default_rng(32)
    x = rng.standard_normal((2_000, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    error = {}
    for t in (0.0, 0.5):
        book = ann.train(x, ann.AnnSpec(threshold=t))
        codes = book.encode(x)
        back = np.stack([book.centres[j][codes[:, j]] for j in range(codes.shape[1])], 1).reshape(len(x), -1)
        error[t] = np.abs(((x - back) * x).sum(1)).mean()
    assert error[0.5] < error[0.0]


CALL = {"type": "object", "properties": {"q": {"type": "string"}, "n": {"type": "integer", "minimum": 1}}, "required": ["q"], "additionalProperties": False}


def call(*calls, content=None):
    return json.dumps({"tool_calls": list(calls)} | ({"content": content} if content else {}))


def result(ident, content):
    return json.dumps({"tool_call_id": ident, "content": content})


def test_chat_links_orders_and_validates(spark):
    one = {"id": "a", "name": "find", "arguments": {"q": "x", "n": 2.0}}
    two = {"id": "b", "name": "find", "arguments": json.dumps({"q": {"$result": "a"}})}
    data = [
        (1, 0, "user", "hello"),
        (1, 1, "assistant", call(one, content="let me see")),
        (1, 2, "tool", result("a", {"z": 1, "a": [1.5]})),
        (1, 3, "tool", result("a", "again")),
        (1, 4, "tool", result("nobody", None)),
        (1, 5, "assistant", call({"id": "c", "name": "find", "arguments": {"n": 0, "extra": 1}}, {"id": "d", "name": "other", "arguments": {}}, {"id": "a", "name": "find", "arguments": {"q": "y"}})),
        # out of order: the result before its call, the call before what it refers to
        (2, 0, "tool", result("b", 1)),
        (2, 1, "assistant", call(two)),
        (2, 2, "tool", result("a", 2)),
        (2, 3, "assistant", call(one)),
        # a cycle
        (3, 0, "assistant", call({"id": "a", "name": "find", "arguments": {"q": {"$result": "b"}}}, {"id": "b", "name": "find", "arguments": {"q": {"$result": "a"}}})),
        (3, 1, "tool", result("a", 1)),
        (3, 2, "tool", result("b", 1)),
        (4, 0, None, None),
        (None, 0, "tool", result("a", 1)),
        (5, None, "user", "{not json"),
        (6, 0, "user", "x" * 100_000),
    ]
    df = spark.createDataFrame([(*x, 1, 2) for x in data], "conv_id long, turn long, role string, text string, part int, status int")
    got = cf.format_chat(df, {"find": CALL}).collect()
    conv = lambda c: sorted((r for r in got if r.conv_id == c), key=lambda r: (r.order_turn, r.order_depth, r.turn, r.part))
    assert all(json.loads(r.json) is not None for r in got) and len(got) == 21
    assert [(r.kind, r.call_id, r.status) for r in conv(1)] == [
        ("text", None, "ok"), ("text", None, "ok"), ("call", "a", "ok"), ("result", "a", "ok"), ("result", "a", "duplicate"), ("result", "nobody", "orphan"),
        ("call", "c", "invalid"), ("call", "d", "invalid"), ("call", "a", "duplicate"),
    ]
    lines = [r.json for r in conv(1)]
    assert lines[2] == '{"arguments":{"n":2,"q":"x"},"errors":[],"id":"a","name":"find","role":"assistant","status":"ok"}'
    assert lines[3] == '{"content":{"a":[1.5],"z":1},"role":"tool","status":"ok","tool_call_id":"a"}'
    assert json.loads(lines[6])["errors"] == ["$.q: missing", "$.extra: unknown", "$.n: too small"]
    assert [(r.kind, r.call_id) for r in conv(2)] == [("call", "a"), ("result", "a"), ("call", "b"), ("result", "b")]
    assert {r.status for r in conv(3) if r.kind == "call"} == {"cyclic"}
    assert cf.format_chat(df.limit(0)).count() == 0


def test_repeated_messages_are_duplicates(spark):
    data = [(1, 0, "assistant", call({"id": "a", "name": "find", "arguments": {"q": "x"}}))] * 3 + [(1, 1, "tool", result("a", 1))] * 2
    got = cf.format_chat(spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(3), {"find": CALL}).collect()
    assert Counter((r.kind, r.status) for r in got) == {("call", "ok"): 1, ("call", "duplicate"): 2, ("result", "ok"): 1, ("result", "duplicate"): 1}


def test_lone_surrogates(spark):
    data = [
        (1, 0, "assistant", '{"tool_calls": [{"id": "\\ud800", "name": "find\\udfff", "arguments": {"q": "a\\ud83d\\ude00\\ud800", "\\udc00": 1}}]}'),
        (1, 1, "tool", '{"tool_call_id": "\\ud800", "content": "\\udabc"}'),
        (1, 2, "assistant", '{"tool_calls": [{"id": "b", "name": "find", "arguments": {"q": {"$result": "\\ud800"}}}], "content": "\\ud800"}'),
    ]
    got = {(r.kind, r.turn): r for r in cf.format_chat(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"), {"find": CALL}).collect()}
    assert got["call", 0].call_id == "\ufffd" and got["result", 1].status == "ok" and '"\\udabc"' in got["result", 1].json
    assert '"a\U0001f600\\ud800"' in got["call", 0].json and "\\udc00" in got["call", 0].json and json.loads(got["text", 2].json)


def test_long_chains_out_of_order(spark):
    """A chain of calls, each waiting for the result of the next one in the log, and a long cycle."""
    n = 40
    ref = lambda i: {"id": f"c{i}", "name": "find", "arguments": {"q": {"$result": f"c{i + 1}"}}}
    data = [(1, 2 * i, "assistant", call(ref(i))) for i in range(n)] + [(1, 2 * i + 1, "tool", result(f"c{i}", i)) for i in range(n)]
    data += [(1, 2 * n, "assistant", call({"id": f"c{n}", "name": "find", "arguments": {"q": "x"}})), (1, 2 * n + 1, "tool", result(f"c{n}", n))]
    data += [(2, i, "assistant", call({**ref(i), "arguments": {"q": {"$result": f"c{(i + 1) % n}"}}})) for i in range(n)] + [(2, n + i, "tool", result(f"c{i}", i)) for i in range(n)]
    loose = {"find": {"type": "object"}}
    got = cf.format_chat(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"), loose).collect()
    chain = sorted((r for r in got if r.conv_id == 1), key=lambda r: (r.order_turn, r.order_depth, r.turn, r.part))
    assert [(r.kind, r.call_id) for r in chain] == [(k, f"c{i}") for i in range(n, -1, -1) for k in ("call", "result")]
    assert {r.status for r in chain} == {"ok"} and {r.status for r in got if r.conv_id == 2} == {"cyclic"}


def brute_places(events):
    """(place, cyclic) of each event by walking back over all paths; events: id -> (turn, part, ids it waits for)."""
    out = {}
    for x in events:
        best, front, cyclic = events[x][:2], {x: 0}, False
        for step in range(1, 2 * len(events) + 1):
            front = {p: step for e in front for p in events[e][2]}
            cyclic = cyclic or step >= len(events) and bool(front)
            best = max([best, *((events[p][0], events[p][1] + step) for p in front)])
        out[x] = (events[x][:2] if cyclic else best, cyclic)
    return out


def test_turns_as_calls_on_the_table(spark):
    """The query's rows, flaws of all kinds among them, against brute force."""
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    messages = cf.turns_as_calls(df).collect()
    got = {(r.conv_id, r.turn, r.kind, r.call_id): r for r in cf.format_chat(cf.turns_as_calls(df)).collect()}
    assert len(got) == len(messages) == df.count()
    by_conv = {}
    for m in messages:
        data = json.loads(m.text) if (m.text or "")[:1] == "{" else {}
        kind = "call" if "tool_calls" in data else "result" if "tool_call_id" in data else "text"
        data = data["tool_calls"][0] if kind == "call" else data
        by_conv.setdefault(m.conv_id, []).append((m.turn, kind, data.get("id", data.get("tool_call_id")), data.get("arguments", {})))
    for conv, rows in by_conv.items():
        first = {}
        for turn, kind, ident, _ in sorted(rows, key=lambda r: r[:2]):
            first.setdefault((kind, ident), turn)
        events = {}
        for turn, kind, ident, args in rows:
            waits = []
            if kind == "result" and first["result", ident] == turn and ("call", ident) in first:
                waits.append(("call", first["call", ident], ident))
            for ref in cf.references(args):
                if ("call", ref) in first and ("result", ref) in first:
                    waits.append(("result", first["result", ref], ref))
            events[kind, turn, ident] = (turn, 0, waits)
        linked = {k: v for k, v in events.items() if k[0] != "text"}
        places = brute_places(linked)
        for turn, kind, ident, args in rows:
            r = got[conv, turn, kind, ident]
            place, cyclic = places.get((kind, turn, ident), ((turn, 0), False))
            bad = kind == "call" and bool(cf.schema_errors(args, cf.TURN_TOOLS["reply"]))
            want = (
                "ok" if kind == "text"
                else "orphan" if kind == "result" and ("call", ident) not in first
                else "duplicate" if first[kind, ident] != turn
                else "cyclic" if cyclic
                else "invalid" if bad
                else "unanswered" if kind == "call" and ("result", ident) not in first
                else "ok"
            )
            assert (r.status, (r.order_turn, r.order_depth)) == (want, place)
    assert {r.status for r in got.values()} == {"ok", "orphan", "duplicate", "cyclic", "invalid", "unanswered"}
    assert any(r.order_turn != r.turn for r in got.values())


def test_canonical_json():
    assert cf.canonical({"b": 1.0, "a": [True, None, "é\n"], "\U0001f600": 1, "דּ": 2}) == '{"a":[true,null,"é\\n"],"b":1,"\U0001f600":1,"דּ":2}'
    for text, want in (("1e15", "1000000000000000"), ("1000000000000000", "1000000000000000"), ("1e-7", "1e-7"), ("1e21", "1e+21"), ("-0.0", "0"), ("1.5e-6", "0.0000015"), ("0.1", "0.1"), ("1e16", "10000000000000000")):
        assert cf.canonical(json.loads(text)) == want
    rng = random.Random(33)
    for _ in range(2_000):
        x = rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-30, 30)
        assert float(cf.canonical(x)) == x


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    seen = [docs]
    for _, stage in cp.STAGES:
        seen.append(cp.stored(stage(spark, seen[-1], "/root/testdata/sf0.001")))
    assert all(x.columns == docs.columns for x in seen[:-1])
    rules, lines, near, mixed, packed = (x.count() for x in seen[1:])
    assert docs.count() > rules >= lines >= near > 0 and packed == mixed
    assert len(rows()) and frame(spark, rows()).count() == len(rows())
    random.seed(0)
    assert cp.run(spark, "/root/testdata/sf0.001").count() == packed


def test_pipeline_near_stage_is_by_row(spark):
    """Ids that several texts share and null ids, against brute force over all rows."""
    import corpus_pipeline as cp

    rng = random.Random(31)
    data = [(None if rng.random() < 0.33 else r[0], *r[1:]) for r in rows(31)]
    text = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    data += [(1_000, text), (1_001, text), (1_001, "a text of its own under an id that is taken"), (1_002, text + " tail"), (1_002, "one more text of its own here")]
    data += [(None, text + " end"), (None, other), (None, other + " end"), (None, other), (None, "alone and without an id"), (1_003, "twice the same row"), (1_003, "twice the same row")]
    data = [(*r, "en", "s", 0)[:5] for r in data]
    group = {i: c for i, _, c in near_components([(i, r[1]) for i, r in enumerate(data)], 5, 80)}
    least = {}
    for i, r in enumerate(data):
        rank = (r[0] is None, r[0] or 0)
        least[group[i]] = min(least.get(group[i], rank), rank)
    named = {r[1]: group[i] if (r[1] or "").split() else r[1] for i, r in enumerate(data)}
    want = Counter((named[data[c][1]], None if null else doc) for c, (null, doc) in least.items())
    docs = frame(spark, data)
    got = cp.near(spark, docs, "")
    assert got.columns == docs.columns
    assert Counter((named[r.text], r.doc_id) for r in got.collect()) == want
    assert cp.near(spark, docs.limit(0), "").count() == 0
