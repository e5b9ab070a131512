"""Text, phonetic and similarity functions, and corruption."""

import random
import unicodedata

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.functions import corrupt as co
from tessera.functions import similarity as sim
from tessera.functions import tables, text
from tessera.functions.phonetic import metaphone, phonetic_key, token_code, with_phonetic_key
from tessera.plans.catalogue import SAMPLES


def test_names_of_all_alphabets(spark):
    names = spark.createDataFrame([(r[0],) for r in SAMPLES] + [(None,)], "name string")
    got = {r.name: (r.norm, r.lat, r.legal_form) for r in text.on_distinct(names, "name", lambda c: text.name_keys(c, True)).collect()}
    assert got.pop(None) == ("", "", None)
    assert got == {r[0]: r[1:] for r in SAMPLES}


def test_armenian_ligature_and_marks(spark):
    df = spark.createDataFrame([("և",), ("ու",), ("é",), ("àb",), ("ﬁn",), ("Ǆ",)], "name string")
    got = {r.name: r.lat for r in text.on_distinct(df, "name", lambda c: {"lat": text.prep(c)}).collect()}
    assert got["և"] == "ev" and got["ու"] == "ov" and got["é"] == "e" and got["ﬁn"] == "fin"


def to_latin(name: str) -> str:
    """The comparison key by its definition."""
    low = unicodedata.normalize("NFKC", name).lower().replace("ё", "е")
    spelled = []
    for ch in low:
        if ch != "_" and unicodedata.category(ch)[0] not in "LN":
            spelled.append(" ")
        elif ch in tables.LETTERS or ch.isascii():
            spelled.append(tables.LETTERS.get(ch, ch))
        else:
            base = "".join(c for c in unicodedata.normalize("NFD", ch) if not unicodedata.combining(c))
            spelled.append(base if base.isascii() else " ")
    return " ".join("".join(spelled).split())


def test_python_and_column_spelling_agree(spark):
    rng = random.Random(1)
    letters = "".join(tables.LETTERS) + "abc XYZ-_'é№漢ßŁ"
    names = ["".join(rng.choice(letters) for _ in range(12)) for _ in range(300)]
    df = spark.createDataFrame([(x,) for x in names], "name string")
    got = {r.name: r.lat for r in text.on_distinct(df, "name", lambda c: {"lat": text.prep(c)}).collect()}
    assert all(got[x] == to_latin(x) for x in names)


def test_keys(spark):
    df = spark.createDataFrame([("petrov ivan a",), ("solo",), ("",), ("  two  words ",)], "lat string")
    got = df.select("lat", text.sorted_tokens("lat").alias("s"), text.prefix_key("lat").alias("p"), text.initials("lat").alias("i"), text.n_tokens("lat").alias("n"), text.soundex_key("lat").alias("x")).collect()
    assert {r.lat: (r.s, r.p, r.i, r.n) for r in got} == {
        "petrov ivan a": ("a ivan petrov", "a|ivan", "pia", 3),
        "solo": ("solo", None, "s", 1),
        "": ("", None, "", 0),
        "  two  words ": ("two words", "two|word", "tw", 2),
    }


def test_safe_name_and_human():
    assert text.safe_name("a b/ç.d") == "a_b_d" and text.human(1234567) == "1 234 567"


@pytest.mark.parametrize(("word", "code"), [("knight", "NT"), ("school", "SKL"), ("phone", "FN"), ("church", "XRX"), ("science", "SNS"), ("judge", "JJ"), ("whale", "WL"), ("xavier", "SFR"), ("thumb", "0M"), ("nation", "NXN"), ("", "")])
def test_metaphone(word, code):
    assert metaphone(word) == code


def test_phonetic_key(spark):
    df = spark.createDataFrame([("petr ivanov",), ("ivanov petr",), ("11111 x",), ("",)], "lat string")
    got = {r.lat: (r.phon, r.direct) for r in with_phonetic_key(df).withColumn("direct", phonetic_key("lat")).collect()}
    assert got["petr ivanov"] == got["ivanov petr"] and all(a == b for a, b in got.values())
    assert got["11111 x"][0] == "1111 S" and got[""][0] == "" and token_code("é") is None


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_kernels_against_definitions():
    rng = random.Random(2)
    for _ in range(500):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randint(0, 10))) for _ in range(2))
        plain = 1.0 if not a and not b else 2 * lcs(a, b) / (len(a) + len(b))
        assert sim.ratio(a, b) == pytest.approx(plain)
        one, two = set(a.split()), set(b.split())
        if one and two:
            both = " ".join(sorted(one & two))
            x, y = (" ".join(filter(None, [both, " ".join(sorted(s))])) for s in (one - two, two - one))
            parts = [sim.ratio(x, y)] + ([sim.ratio(both, x), sim.ratio(both, y)] if both else [])
            assert sim.token_set(a, b) == pytest.approx(max(parts))
        else:
            assert sim.token_set(a, b) == 0
        short, long = sorted((a, b), key=len)
        if short:
            m, n = len(short), len(long)
            stretches = [long[max(0, e - m) : min(n, e)] for e in range(1, n + m)]
            assert sim.partial(a, b) == pytest.approx(max(sim.ratio(short, s) for s in stretches))
        assert all(0 <= f(a, b) <= 1 for f in (sim.partial, sim.jaro_winkler, sim.token_sort))
    assert sim.jaro_winkler("martha", "marhta") == pytest.approx(0.9611, abs=1e-4)


def test_pair_features(spark):
    df = spark.createDataFrame([("petr ivanov", "ivanov petr", "a", "a"), ("", "", "", ""), ("x", "", "S", "")], "left string, right string, left_phon string, right_phon string")
    rows = {r.left: r for r in sim.pair_features(df).collect()}
    assert [c for c in sim.FEATURES if c not in rows[""].asDict()] == []
    swapped = rows["petr ivanov"]
    assert (swapped.token_sort, swapped.token_set, swapped.same_phon, swapped.same_init, swapped.min_tokens) == (1, 1, 1, 0, 2)
    assert rows[""].levenshtein == 1 and rows["x"].levenshtein == 0 and rows["x"].len_diff == 0.5


def test_batches_equal_single_pairs():
    """The kernels of a batch against those of a pair, long names and odd characters among them."""
    rng = random.Random(4)
    some = lambda: "".join(rng.choice("abc ") for _ in range(rng.randint(0, 14)))
    left, right = ([some() for _ in range(700)] for _ in range(2))
    left += ["x" * 80, "abc def", "", "é漢 b", "a" * 63]
    right += ["x" * 70 + "y", "abc def ghi", "", "é b", "a" * 62 + "b"]
    for together, alone in zip(sim.KERNELS, (sim.ratio, sim.token_sort, sim.token_set, sim.partial, sim.jaro_winkler), strict=True):
        assert together(pd.Series(left), pd.Series(right)).tolist() == pytest.approx([alone(a, b) for a, b in zip(left, right, strict=True)])
    assert all(len(f(pd.Series([], dtype=object), pd.Series([], dtype=object))) == 0 for f in sim.KERNELS)


def made(spark, names, op, seeds=20):
    """What an operator makes of each name, by name."""
    df = spark.createDataFrame([(x, i) for x in names for i in range(seeds)], "name string, seed long").repartition(3)
    out = {}
    for r in df.select("name", co.OPERATORS[op](F.col("name"), F.col("seed")).alias("out")).collect():
        out.setdefault(r.name, set()).add(r.out)
    return out


def test_corruptions_one_by_one(spark):
    got = made(spark, ["Әсел қ", "plain"], "fold_diacritics")
    assert got == {"Әсел қ": {"Әсел к"}, "plain": {"plain"}}
    assert made(spark, ["Иванов Пётр С", "solo"], "abbreviate") == {"Иванов Пётр С": {"Иванов П С"}, "solo": {"solo"}}
    assert made(spark, ["a b", "a b c"], "drop_token") == {"a b": {"a b"}, "a b c": {"a b", "a c"}}
    assert made(spark, ["a b", "a b c", "x"], "swap_tokens") == {"a b": {"b a"}, "a b c": {"b a c", "a c b"}, "x": {"x"}}
    forms = made(spark, ["ХХК Найз", "Найз", "xllcx", "ООО Ромашка"], "swap_legal_form", 60)
    assert forms["ХХК Найз"] == {"хк найз", "llc найз"} and forms["Найз"] == {"Найз"} and forms["xllcx"] == {"xllcx"}
    assert forms["ООО Ромашка"] == {f"{x} ромашка" for x in ("общество с ограниченной ответственностью", "llc", "ltd")}
    typos = made(spark, ["abc", "salt"], "typo", 300)
    assert typos["abc"] == {"abc"}
    near = {"salt"[:i] + c + "salt"[i + 1 :] for i, ch in enumerate("salt") for c in tables.NEIGHBOUR_KEYS[ch]}
    lost = {"salt"[:i] + "salt"[i + 1 :] for i in range(4)}
    twice = {"salt"[: i + 1] + "salt"[i:] for i in range(4)}
    assert typos["salt"] <= near | lost | twice | {"aslt", "slat", "satl", "salt"} and typos["salt"] & near and typos["salt"] & lost and typos["salt"] & twice
    spelled = made(spark, ["zhukov", "bbb"], "alt_translit", 100)
    one = {"zhukov".replace(k, v, 1) for k, others in tables.OTHER_SPELLINGS.items() if k in "zhukov" for v in others}
    assert spelled["zhukov"] <= one and len(spelled["zhukov"]) > 5 and spelled["bbb"] == {"bbb"}
    latin = made(spark, ["Жуков"], "to_latin_variant", 100)["Жуков"]
    assert all(x.isascii() for x in latin) and "zhukov" not in latin and latin & one


def test_corruption_is_seeded_and_changes(spark):
    names = ["Иванов Пётр Сергеевич", "Ғабдуллин Қанат", 'ООО "Ромашка"', "ab", "", None]
    df = spark.createDataFrame([(x, n, i) for x in names for n in range(4) for i in range(10)], "name string, n int, seed long")
    run = lambda d: {(r.name, r.n, r.seed): (r.c.out, tuple(r.c.ops)) for r in d.select("*", co.corrupted(F.col("name"), F.col("n"), F.col("seed")).alias("c")).collect()}
    got = run(df)
    assert got == run(df.repartition(7))
    for (name, n, _), (out, ops) in got.items():
        assert len(ops) <= n and set(ops) <= set(co.OPERATORS) and (bool(ops) or out == (name or ""))
    assert len({out for (name, n, _), (out, _) in got.items() if name == names[0] and n == 2}) > 5
    assert all(len(ops) == n for (name, n, _), (_, ops) in got.items() if name == names[0])
    only = df.select("name", "n", co.corrupted(F.col("name"), F.col("n"), F.col("seed"), allowed=["abbreviate"]).alias("c")).where("n = 3 and name like 'Иванов%'").collect()
    assert {(r.c.out, tuple(r.c.ops)) for r in only} == {("Иванов П С", ("abbreviate",))}
