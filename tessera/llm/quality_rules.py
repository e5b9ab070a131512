"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation
estimates how accurate each is, and the posterior decides.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WORD_PATTERN, stored, words

GOOD, BAD, ABSTAIN = 1, 0, -1
#: The columns of features().
OWN = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lines", "n_upper", "n_marks")
SYMBOLS = "[#*$%&|<>]"
#: Rounds of expectation-maximisation; the estimates are stable before.
ROUNDS = 25
#: Where the share of bad texts and the rules' accuracies start.  PRIOR_WEIGHT is what the
#: start weighs beside the votes, at any number of them.
START_BAD, START_ACCURACY, PRIOR_WEIGHT = 0.1, 0.9, 0.01


def repeated_words(df: DataFrame) -> DataFrame:
    """Add n_repeat_words from __words: how many words stand in a three-word window that
    the text has twice or more.  Windows are compared by 64-bit hash; only texts in
    which some hash recurs are sorted.
    """
    n = F.size("__words")
    df = df.withColumn(
        "__grams",
        F.when(
            n >= 3,
            F.transform(
                F.sequence(F.lit(0), n - 3),
                lambda i: F.xxhash64(F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2)),
            ),
        ),
    )
    df = df.withColumn("__recurs", F.size(F.array_distinct("__grams")) < F.size("__grams"))
    df = df.withColumn(
        "__sorted",
        F.when(F.col("__recurs"), F.sort_array(F.transform("__grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )
    same = lambda x, k: (F.get("__sorted", k).getField("h") == x.getField("h"))
    repeats = F.filter(
        "__sorted", lambda x, k: F.coalesce(same(x, k + 1), F.lit(False)) | F.coalesce((k > 0) & same(x, k - 1), F.lit(False))
    )
    at = F.transform(repeats, lambda x: F.array(x.getField("i"), x.getField("i") + 1, x.getField("i") + 2))
    df = df.withColumn("n_repeat_words", F.when(F.col("__recurs"), F.size(F.array_distinct(F.flatten(at)))).otherwise(0).cast("long"))
    return df.drop("__grams", "__recurs", "__sorted")


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed
    and the votes' inputs; a column of docs with such a name gives way.

    A null text counts as empty.  Lines are split at \\n and count if they hold a word.
    """
    body = F.coalesce(F.col("__text"), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD_PATTERN[:-1]))
    df = docs.drop(*OWN).withColumn("__text", F.col(text)).withColumn("__words", words(F.col("__text")))
    df = df.withColumn("__lines", lines).withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "word_chars": F.length(F.array_join("__words", "")).cast("long"),
            "n_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("long"),
            "n_upper": F.regexp_count(body, F.lit("[A-Z]")).cast("long"),
            "n_marks": F.regexp_count(body, F.lit("[!?]")).cast("long"),
            "n_lines": F.size("__lines").cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        }
    )
    df = repeated_words(df).drop("__words", "__lines", "__text")
    # a row number is never negative: asking for it keeps the optimizer from copying the expressions above into
    # a later filter, where an array would be made again for each of its elements
    barrier = F.monotonically_increasing_id() >= 0
    return df.withColumn("base_failed", barrier & ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))))


def votes() -> dict[str, Column]:
    """The rules, by shares of the text's words, characters or lines.

    Seven look for a fault each and vote bad or abstain, some of them for the same fault by
    another measure.  Two vote good or abstain: clean where the characters are those of prose,
    fresh where the words are.  Neither looks at lines, and both allow some repetition, so a
    text may have votes of either kind, and the estimated accuracies decide.
    """
    c = F.col
    bad = lambda sign: F.when(sign, BAD).otherwise(ABSTAIN)
    good = lambda sign: F.when((c("n_words") > 0) & sign, GOOD).otherwise(ABSTAIN)
    common_size = (c("word_chars") >= 3 * c("n_words")) & (c("word_chars") <= 12 * c("n_words"))
    return {
        "symbols": bad(10 * c("n_symbols") > c("n_words")),
        "symbol_chars": bad(20 * c("n_symbols") > c("word_chars")),
        "capitals": bad(10 * c("n_upper") > 3 * c("word_chars")),
        "marks": bad(5 * c("n_marks") > c("n_words")),
        "lines": bad(10 * c("n_dup_lines") > 3 * c("n_lines")),
        "repeats": bad(10 * c("n_repeat_words") > 4 * c("n_words")),
        "word_size": bad(~common_size),
        "clean": good((50 * c("n_symbols") <= c("n_words")) & (5 * c("n_upper") <= c("word_chars")) & (20 * c("n_marks") <= c("n_words")) & (2 * c("n_repeat_words") <= c("n_words"))),
        "fresh": good((100 * c("n_symbols") <= c("word_chars")) & (10 * c("n_repeat_words") <= 3 * c("n_words")) & common_size),
    }


def estimate(patterns: DataFrame, rules: int, rounds: int = ROUNDS) -> DataFrame:
    """One row (a: array: the share of bad texts, then each rule's accuracy where it votes).

    patterns: (votes array<int>, n long), one row per combination: a rule has two votes, so
    2 ** rules rows at most, however many documents there are.  The whole estimation is one
    expression over the array of these rows.  No rows, or a rule without votes: the
    starting value.
    """
    table = patterns.agg(
        F.sort_array(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n")))).alias("rows")
    )
    start = F.array(F.lit(START_BAD), *[F.lit(START_ACCURACY)] * rules)

    def step(model: Column, _: Column) -> Column:
        judged = F.transform("rows", lambda r: F.struct(r["votes"].alias("v"), r["n"].alias("w"), bad_chance(r["votes"], model).alias("q")))
        # for the class and each rule: weight of what is bad or right, and of all
        zero = F.array_repeat(F.array(F.lit(0.0), F.lit(0.0)), rules + 1)
        sums = F.aggregate(
            judged,
            zero,
            lambda acc, r: F.zip_with(
                acc,
                F.concat(F.array(F.lit(BAD)), r["v"]),
                lambda s, v: F.array(
                    s[0] + F.when(v == BAD, r["w"] * r["q"]).when(v == GOOD, r["w"] * (1 - r["q"])).otherwise(0.0),
                    s[1] + F.when(v != ABSTAIN, r["w"]).otherwise(0.0),
                ),
            ),
        )
        return F.zip_with(sums, start, lambda s, begin: F.when(s[1] > 0, (s[0] / s[1] + PRIOR_WEIGHT * begin) / (1 + PRIOR_WEIGHT)).otherwise(begin))

    return table.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step).alias("a"))


def bad_chance(v: Column, model: Column) -> Column:
    """Posterior chance that a text with these votes is bad.  model: the array of estimate().

    A rule's accuracy is the chance that its vote is right, the share of its class included;
    so a vote's weight is its log-odds over those of the class, and never speaks against
    itself.  One vote alone thus gives its rule's accuracy.  Rules are taken as independent
    given the class, abstentions say nothing.
    """
    odds = lambda x: F.log(x / (1 - x))
    prior = odds(F.get(model, F.lit(0)))
    weight = F.zip_with(
        v,
        F.slice(model, F.lit(2), F.size(v)),
        lambda x, a: F.when(x == BAD, F.greatest(odds(a) - prior, F.lit(0.0))).when(x == GOOD, -F.greatest(odds(a) + prior, F.lit(0.0))).otherwise(0.0),
    )
    return 1 / (1 + F.exp(-F.aggregate(weight, prior, lambda s, x: s + x)))


def quality_rules(docs: DataFrame, text: str = "text", threshold: float = 0.5, carry: list[str] | None = None) -> DataFrame:
    """docs with the features, votes (array), good_probability and kept.

    kept: not base_failed, and the posterior probability of being good is at least the
    threshold.  One pass over the texts: the features are stored along with the columns of
    docs that carry names (all by default), and the votes are counted and judged from that
    table.  Only the counts of vote combinations are shuffled (2 ** rules rows at most).

    Null and empty texts have no words, so base_failed holds.  Texts of any length are
    judged whole.  Repeated rows are judged alike.  No rows give no rows.  Columns of
    docs that clash with the new ones give way; all others are kept.
    """
    names = votes()
    made = features(docs, text)
    if carry is not None:
        made = made.select(*carry, *[c for c in made.columns if c in OWN])
    made = stored(made.drop("votes", "good_probability", "kept", "__model").withColumn("votes", F.array(*names.values())))
    # a scalar subquery: one row by construction
    model = estimate(made.groupBy("votes").agg(F.count("*").alias("n")), len(names)).scalar()
    out = made.withColumn("__model", model)
    out = out.withColumn("good_probability", 1 - bad_chance(F.col("votes"), F.col("__model"))).drop("__model")
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("good_probability") >= threshold))
