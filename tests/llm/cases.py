"""Small documents that hold the awkward cases, and brute-force versions of the operators."""

import hashlib
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id string, size int, kept string, n_words string, copies int, line int, doc int, _hash int"


def words(text):
    return WORD.findall(text or "")


def rows(seed=1, n=60):
    """Documents with copies, near copies, shared passages, nulls, empty and long texts, and repeated rows."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(400)] + ["é", "Straße", "naïve", "漢字"]
    line = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passage = line(40)
    texts = ["\n".join(line(rng.randint(1, 14)) for _ in range(rng.randint(1, 12))) for _ in range(n)]
    texts += [texts[0], texts[0], texts[1] + " tail", passage, passage + "\n" + texts[2], texts[3][:40] + passage + texts[3][40:]]
    near = line(120).split()
    texts.append(" ".join(near))
    for i in range(6):
        other = list(near)
        other[i * 7] = "changed"
        texts.append(" ".join(other))
    texts += [None, "", " \n\t ", "one", "ab " * 700, line(6_000), "a\nb\na\nb", "THE SAME LINE OF TEXT\nThe same line of text\nthe same line of texts"]
    texts += ["the quick brown fox jumps over it\nanother line", "the quick brown fox jumped over it\nx", "the quick brown fox jumpe over it"]
    out = [(i, t, "en", f"s{i % 4}" if i % 9 else None, len(t or "")) for i, t in enumerate(texts)]
    out += [out[5], out[5], (7, "another text under an id that is taken " + texts[8], "en", "s1", 3)]
    rng.shuffle(out)
    return out


def frame(spark, data):
    """documents with columns whose names clash with those of the operators."""
    return spark.createDataFrame([(*r, "x", 1, "y", "z", 2, 3, 4, 5) for r in data], SCHEMA).repartition(3)


def removed_repeats(data, length):
    """(doc_id, n_bytes, n_removed, n_spans, sha256) by a table of all strings."""
    first = {}
    for doc, text, *_ in data:
        body = (text or "").encode()
        for s in range(len(body) - length + 1):
            at = (doc, hashlib.md5(body).hexdigest(), s)
            first[body[s : s + length]] = min(first.get(body[s : s + length], at), at)
    out = []
    for doc, text, *_ in data:
        body = (text or "").encode()
        gone = bytearray(len(body))
        for s in range(len(body) - length + 1):
            if first[body[s : s + length]] < (doc, hashlib.md5(body).hexdigest(), s):
                gone[s : s + length] = b"\1" * length
        rest = bytes(b for b, g in zip(body, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((doc, len(body), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out)


def near_components(data, n, percent):
    """(doc_id, n_shingles, component_id) by comparing all pairs of sets."""
    fold = {c: c + 32 for c in range(65, 91)}

    def shingles(text):
        w = words((text or "").translate(fold))
        return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])

    sets = [(doc, shingles(text)) for doc, text, *_ in data]
    label = list(range(len(sets)))

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            both = len(a & b)
            if a and 100 * both >= percent * (len(a) + len(b) - both):
                label[top(i)] = top(j)
    least = {}
    for i, (doc, a) in enumerate(sets):
        least[top(i)] = min(least.get(top(i), doc), doc)
    return sorted((doc, len(a), least[top(i)] if a else doc) for i, (doc, a) in enumerate(sets))


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]
