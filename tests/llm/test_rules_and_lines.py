"""Quality rules (7), line dedup (4) and the classifier (10)."""

import random
from collections import Counter

import numpy as np
import pytest
from cases import WORD, edit_distance, frame, rows, words

from tessera.llm import quality_classifier as qc
from tessera.llm.line_dedup import count_classes, dedup_lines, edit_distance_within, line_keys, segments
from tessera.llm.quality_rules import estimate, quality_rules, votes


def base(text):
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed


def test_quality_rules_base(spark):
    data = rows()
    data.append((900, " ".join(f"w{i}***" for i in range(80)), "en", "s1", 0))
    data.append((901, "x | y\x0b<b>\x0c" + " ".join(f"v{i}" for i in range(60)), "en", "s1", 0))
    got = quality_rules(frame(spark, data))
    assert {"lang", "source", "copies"} <= set(got.columns)
    got = got.collect()
    found = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    assert found == sorted((d, *base(t)) for d, t, *_ in data)
    # by row: an id may have a text that fails and one that does not
    assert not any(r.kept for r in got if base(r.text)[5] or r.doc_id == 900) and any(r.kept for r in got)


def test_quality_rules_filter_and_empty(spark):
    data = rows(2)
    df = frame(spark, data)
    kept = quality_rules(df).where("kept").select(*df.columns).count()
    assert 0 < kept < len(data)
    assert quality_rules(df.limit(0)).count() == 0
    assert quality_rules(spark.createDataFrame([(None, None)], "doc_id long, text string")).first().kept is False


def test_estimate_learns_accuracies(spark):
    """Two rules agree, a third contradicts them at random: it is worth less."""
    rng = random.Random(3)
    counts = Counter()
    for _ in range(20_000):
        bad = rng.random() < 0.3
        vote = lambda right: int(bad != (rng.random() < right))  # noqa: E731,B023
        counts[(vote(0.95), vote(0.95), vote(0.55))] += 1
    table = spark.createDataFrame([(list(k), n) for k, n in counts.items()], "votes array<int>, n long")
    bad, *a = estimate(table, 3).first().a
    assert min(a[0], a[1]) > a[2] + 0.1 and abs(bad - 0.3) < 0.05
    assert estimate(table.limit(0), 3).first().a == [0.1, 0.9, 0.9, 0.9]


def test_posterior_overrules_a_bad_vote(spark):
    """Repeated lines alone do not reject a text that two rules call good; symbols do."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    text = lambda: "\n".join(" ".join(word() for _ in range(30)) for _ in range(4))
    data = [(i, text()) for i in range(200)]
    data += [(200 + i, "\n".join(["one line that is there twice", " ".join(word() for _ in range(100)), "one line that is there twice"])) for i in range(10)]
    data += [(300 + i, " ".join(f"{word()} |" for _ in range(100))) for i in range(20)]
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    lines = list(votes()).index("lines")
    assert all(got[200 + i].votes.count(0) == 1 and got[200 + i].votes[lines] == 0 for i in range(10))
    assert all(got[i].kept == (i < 300 and not got[i].base_failed) for i in got) and not got[205].base_failed
    slim = quality_rules(spark.createDataFrame(data, "doc_id long, text string"), carry=["doc_id"])
    assert "text" not in slim.columns and slim.where("kept").count() == sum(r.kept for r in got.values())


def brute_lines(data, tau=2, ratio=0.1):
    places = {}
    for doc, text, *_ in data:
        for no, line in enumerate((text or "").split("\n") if text is not None else []):
            if WORD.search(line):
                places.setdefault(line, []).append((doc, no))
    lines = sorted(places)
    label = {x: x for x in lines}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(lines):
        for b in lines[:i]:
            if abs(len(a) - len(b)) <= tau and max(len(a), len(b)) >= 10:
                d = edit_distance(a, b)
                if d <= tau and d <= ratio * max(len(a), len(b)):
                    label[top(a)] = top(b)
    first = {}
    for x in lines:
        first[top(x)] = min(first.get(top(x), min(places[x])), min(places[x]))
    out = []
    for doc, text, *_ in data:
        parts = [] if text is None else text.split("\n")
        keep = [x for no, x in enumerate(parts) if not WORD.search(x) or first[top(x)] == (doc, no)]
        out.append((doc, sum(bool(WORD.search(x)) for x in parts), len(parts) - len(keep), None if text is None else "\n".join(keep)))
    return sorted(out, key=repr)


def test_line_dedup(spark):
    data = [r for r in rows(4, 30) if len(r[1] or "") < 5_000]
    data.append((None, "a line without an id\nthe quick brown fox jumps over it", None, None, 0))
    got = dedup_lines(frame(spark, data))
    assert got.columns[: len(frame(spark, data).columns)] == frame(spark, data).columns
    found = sorted(((r.doc_id, r.n_lines, r.n_removed, r.text) for r in got.collect()), key=repr)
    last = [((1 << 63) - 1 if d is None else d, *x) for d, *x in data]
    wanted = sorted(((None if d == (1 << 63) - 1 else d, *x) for d, *x in brute_lines(last)), key=repr)
    assert found == wanted
    assert dedup_lines(frame(spark, data).limit(0)).count() == 0


def test_line_dedup_hot_key(spark, monkeypatch):
    """Very many lines under one key, all within two edits or far apart."""
    import tessera.llm.line_dedup as ld

    monkeypatch.setattr(ld, "BLOCK_LINES", 8)
    start = "one common beginning of a line that all share "
    data = [(i, start + f"{chr(97 + i % 26)}{i // 26}" + ("" if i % 3 else " end of it"), "en", "s", 0) for i in range(60)]
    found = sorted(((r.doc_id, r.n_lines, r.n_removed, r.text) for r in dedup_lines(frame(spark, data)).collect()), key=repr)
    assert found == brute_lines(data)


def test_line_dedup_numbered_lines(spark, monkeypatch):
    """Lines with one beginning and a different number, long lines among them, in many blocks."""
    import tessera.llm.line_dedup as ld

    monkeypatch.setattr(ld, "BLOCK_LINES", 40)
    rng = random.Random(9)
    numbers = rng.sample(range(10**6, 10**7), 150)
    data = [(i, f"see the entry under the number {n} of the register", "en", "s", 0) for i, n in enumerate(numbers)]
    data += [(1_000 + i, "x" * 400 + str(n), "en", "s", 0) for i, n in enumerate(numbers[:20])]
    found = sorted(((r.doc_id, r.n_lines, r.n_removed, r.text) for r in dedup_lines(frame(spark, data)).collect()), key=repr)
    assert found == brute_lines(data)


def test_line_dedup_very_long(spark):
    """Lines of 300,000 characters with edits at both ends, and a document of 100,000 equal lines."""
    rng = random.Random(10)
    body = "".join(rng.choice("abcdefgh ") for _ in range(300_000))
    data = [(0, body), (1, "y" + body[1:-1] + "z"), (2, "y" + body[2:-2] + "z"), (3, "\n".join(["the very same line"] * 100_000))]
    got = {r.doc_id: (r.n_lines, r.n_removed, len(r.text)) for r in dedup_lines(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == {0: (1, 0, 300_000), 1: (1, 1, 0), 2: (1, 1, 0), 3: (100_000, 99_999, 18)}


def test_groups_stream_over_batches(spark):
    """Keys that go on over several Arrow batches."""
    from tessera.llm.line_dedup import _groups

    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        data = [(1, x, x in (5, 7)) for x in range(3, 14)] + [(1, 5, False), (2, 1, False), (2, 2, False), (3, 4, True), (3, 4, False)] + [(4, x, True) for x in range(8)]
        got = sorted(map(tuple, _groups(spark.createDataFrame(data, "key long, line long, own boolean")).collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == sorted([(1, 5, x, x == 7) for x in range(3, 14) if x != 5] + [(4, 0, x, True) for x in range(1, 8)])


def test_edit_distance_within():
    rng = random.Random(5)
    for _ in range(3_000):
        a = "".join(rng.choice("abcé") for _ in range(rng.randint(0, 14)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "x"])
        b = "".join(b)
        d = edit_distance(a, b)
        for tau in (1, 2, 3):
            assert edit_distance_within(a, b, tau) == (d if d <= tau else None)


def test_segments_meet():
    """Two lines within the threshold share a key at which one of them is listed."""
    rng = random.Random(6)
    for _ in range(300):
        a = "".join(rng.choice("abcdeé") for _ in range(rng.randint(9, 40)))
        b = list(a)
        for _ in range(2):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "x"])
        b = "".join(b)
        if len(b) < 9:
            continue
        data = np.frombuffer((a + b).encode(), np.uint8)
        row, key, own = line_keys(data, np.asarray([0, len(a.encode()), len(data)]), 2, 9)
        one, two = (set(zip(key[row == r].tolist(), own[row == r].tolist())) for r in (0, 1))
        assert any((k, True) in two or o and (k, False) in two for k, o in one)
        classes = count_classes(data, np.asarray([0, len(a.encode()), len(data)])).astype(int)
        assert abs(classes[0] - classes[1]).sum() <= 4
    size = np.asarray([9, 10, 11])
    assert [sum(segments(size, i, 2)[1][k] for i in range(3)) for k in range(3)] == [9, 10, 11]


def test_classifier(spark):
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    good = lambda: " ".join(rng.choice(vocabulary) for _ in range(120)) + "."
    data = [(i, good() if i % 4 else " ".join(w.upper() + "!!" for w in good().split()), "en", "s", 0) for i in range(400)]
    awkward = [(1_000, None, None, None, 0), (1_001, "", None, None, 0), (1_002, good() * 200, None, None, 0), data[1]]
    got = {}
    for r in qc.classify(frame(spark, data + awkward)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(got[1]) == 2 and got[1][0] == got[1][1]
    assert {1_000, 1_001, 1_002} <= set(got)
    # held-out accuracy: texts that did not train the scorer
    model = qc.train(frame(spark, data[:200]))
    held = qc.classify(frame(spark, data[200:]), model=model).collect()
    assert np.mean([r.kept == bool(r.doc_id % 4) for r in held]) > 0.97
    assert qc.classify(frame(spark, []).limit(0)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_classifier_on_labels(spark, sf):
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = qc.classify(docs).join(labels, "doc_id").collect()
    right = np.mean([r.kept == bool(r.quality) for r in rows])
    clean = np.mean([r.kept for r in rows if r.quality])
    assert right > 0.9 and clean > 0.97
