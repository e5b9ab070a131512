"""Quality classifier from weak labels.

Overlapping heuristic labellers vote or abstain on every document; expectation-maximisation
over the counts of vote combinations estimates their accuracies; the posterior labels of a
bounded sample train a linear scorer over hashed words and word shapes, which then scores
every document, also those on which no labeller speaks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import mix64, text_chunks, word_hashes

BAD, GOOD, ABSTAIN = 0, 1, -1


@dataclass(frozen=True)
class ClassifierSpec:
    """bits: log2 of the hashed features; sample: documents that train the scorer at most
    (votes are counted over all); rounds of expectation-maximisation; epochs, step and
    decay of the scorer's training; threshold on the score.
    """

    bits: int = 18
    sample: int = 8_192
    rounds: int = 50
    epochs: int = 12
    step: float = 0.5
    decay: float = 1e-6
    threshold: float = 0.5
    seed: int = 5


#: The labellers, in the order of the votes.
LABELLERS = ("short", "symbols", "capitals", "marks", "bars", "line_repeats", "word_repeats", "one_word", "clean", "fresh")
_SHAPE = np.zeros(256, np.uint8)  # classes of bytes: 0 space and others, 1 lower, 2 upper, 3 digit, 4 mark, 5 symbol, 6 bar
_SHAPE[0x61:0x7B], _SHAPE[0x41:0x5B], _SHAPE[0x30:0x3A] = 1, 2, 3
_SHAPE[0x80:] = 1
_SHAPE[[ord(c) for c in "!?"]] = 4
_SHAPE[[ord(c) for c in "#*$%&<>=_~^{}[]\\"]] = 5
_SHAPE[ord("|")] = 6


def _per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def vote_chunk(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Votes (rows, labellers) of a chunk of texts; whole texts count."""
    hashes, first = word_hashes(data, offsets)
    n = np.diff(first)
    shape = _SHAPE[data]
    kinds = [_per_row(shape == k, offsets) for k in range(7)]
    letters = kinds[1] + kinds[2]
    words, text = np.maximum(n, 1), np.maximum(letters, 1)
    ends = np.flatnonzero(data == 0x0A)
    line_repeats, distinct, common = np.zeros(len(n)), np.ones(len(n)), np.zeros(len(n))
    for i in range(len(n)):
        own = hashes[first[i] : first[i + 1]]
        if len(own) < 30:  # too few words to tell repetition from chance
            continue
        kinds_of, counts = np.unique(own, return_counts=True)
        # a text of this many words has about as many different ones as its root times ten
        distinct[i] = len(kinds_of) / min(len(own), 10 * len(own) ** 0.5)
        common[i] = counts.max() / len(own)
        lo, hi = offsets[i], offsets[i + 1]
        cut = ends[np.searchsorted(ends, lo) : np.searchsorted(ends, hi)]
        if len(cut):
            lines = [x for x in data[lo:hi].tobytes().split(b"\n") if x.strip()]
            line_repeats[i] = 1 - len(set(lines)) / max(len(lines), 1)
    # eight labellers vote bad beyond a limit of one sign; two vote good, each by several signs
    # but not by repeated lines, of which whole and varied texts may have some
    symbols, capitals, marks, bars = kinds[5] / words, kinds[2] / text, kinds[4] / words, kinds[6] / words
    variety, many = 1 - distinct, n >= 3
    faults = (~many, symbols > 0.2, capitals > 0.4, marks > 0.2, bars > 0.2, line_repeats > 0.3, variety > 0.65, common > 0.3)
    clean = many & (symbols <= 0.05) & (capitals <= 0.2) & (marks <= 0.1) & (bars <= 0.05) & (variety <= 0.7) & (common <= 0.3)
    fresh = many & (variety <= 0.4) & (common <= 0.2) & (bars <= 0.1) & (symbols <= 0.1)
    return np.stack([np.where(x, BAD, ABSTAIN) for x in faults] + [np.where(x, GOOD, ABSTAIN) for x in (clean, fresh)], 1).astype(np.int8)


#: Where the share of bad texts and the accuracies start, and what that weighs beside the votes.
START_BAD, START_ACCURACY, PRIOR_WEIGHT = 0.1, 0.9, 0.01


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(accuracy of each labeller where it speaks, chance of good per vote combination, share of bad).

    Estimated by expectation-maximisation over the counted combinations; labellers are taken
    as independent given the class.  An accuracy is the chance that a vote is right, the share
    of its class included: a vote weighs by its log-odds over those of the class, and never
    speaks against itself.  So one vote alone gives its labeller's accuracy.
    """
    right, bad = np.full(votes.shape[1], START_ACCURACY), START_BAD
    spoke, says_good = votes != ABSTAIN, votes == GOOD
    total, everyone = (counts[:, None] * spoke).sum(0), counts.sum()
    chance = np.full(len(votes), 1 - START_BAD)
    for _ in range(rounds):
        prior, odds = np.log(bad / (1 - bad)), np.log(right / (1 - right))
        weight = np.where(says_good, -np.maximum(odds + prior, 0), np.maximum(odds - prior, 0)) * spoke
        chance = 1 / (1 + np.exp(prior + weight.sum(1)))
        hit = (counts[:, None] * spoke * np.where(says_good, chance[:, None], 1 - chance[:, None])).sum(0)
        right = np.where(total > 0, (hit / np.maximum(total, 1) + PRIOR_WEIGHT * START_ACCURACY) / (1 + PRIOR_WEIGHT), START_ACCURACY)
        bad = float(((counts * (1 - chance)).sum() / everyone + PRIOR_WEIGHT * START_BAD) / (1 + PRIOR_WEIGHT)) if everyone else START_BAD
    return right, chance, bad


def hashed_features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value): relative frequencies of hashed words and of hashed word shapes."""
    hashes, first = word_hashes(data, offsets)
    # a word's shape: its classes of bytes, runs of one class counting once
    shape = _SHAPE[data].copy()
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    keep = np.ones(len(data), bool)
    keep[1:] = (shape[1:] != shape[:-1]) | space[1:] | space[:-1]
    new_offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
    shapes, shape_first = word_hashes(np.where(space, 0x20, shape + 0x30).astype(np.uint8)[keep], new_offsets, lower=False)
    size = np.uint64(1 << bits)
    rows = np.arange(len(offsets) - 1)
    row = np.concatenate([np.repeat(rows, np.diff(first)), np.repeat(rows, np.diff(shape_first))])
    feature = np.concatenate([mix64(hashes) % size, mix64(shapes ^ np.uint64(0x5A5A5A5A)) % size]).astype(np.int64)
    key, count = np.unique(row * (1 << bits) + feature, return_counts=True)
    row, feature = key >> bits, key & ((1 << bits) - 1)
    words = np.maximum(np.diff(first), 1)
    return row, feature, np.sqrt(count / words[row])


def fit(row: np.ndarray, feature: np.ndarray, value: np.ndarray, label: np.ndarray, spec: ClassifierSpec) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by AdaGrad over shuffled batches."""
    size, n = 1 << spec.bits, len(label)
    weights, squares, bias = np.zeros(size), np.full(size, 1e-3), 0.0
    begin = np.searchsorted(row, np.arange(n + 1))
    rng = np.random.default_rng(spec.seed)
    for _ in range(spec.epochs):
        order = rng.permutation(n)
        for lo in range(0, n, 256):
            mine = order[lo : lo + 256]
            at = np.concatenate([np.arange(begin[i], begin[i + 1]) for i in mine]) if len(mine) else np.zeros(0, int)
            who = np.repeat(np.arange(len(mine)), begin[mine + 1] - begin[mine])
            f, v = feature[at], value[at]
            score = np.bincount(who, weights[f] * v, len(mine)) + bias
            error = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - label[mine]
            touched, back = np.unique(f, return_inverse=True)
            slope = np.bincount(back, error[who] * v) / len(mine) + spec.decay * weights[touched]
            squares[touched] += slope**2
            weights[touched] -= spec.step * slope / np.sqrt(squares[touched])
            bias -= 0.1 * error.mean()
    return weights, bias


@dataclass
class QualityModel:
    accuracies: np.ndarray
    bad_share: float
    patterns: dict[bytes, float]
    weights: np.ndarray
    bias: float
    spec: ClassifierSpec


def linear_score(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray, bias: float, bits: int) -> np.ndarray:
    """The scorer's chance of good for each text of a chunk."""
    row, feature, value = hashed_features(data, offsets, bits)
    z = np.bincount(row, weights[feature] * value, len(offsets) - 1) + bias
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(docs: DataFrame, spec: ClassifierSpec = ClassifierSpec(), text: str = "text") -> QualityModel:
    """Estimate the labellers over all documents and fit the scorer on the sample.

    The driver gets a row per vote combination (2 ** 10 at most) and the features of the
    sample: the documents with the smallest text hashes, the same for any partitioning.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}  # 2 ** 10 keys at most
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                pattern, n = np.unique(vote_chunk(data, offsets), axis=0, return_counts=True)
                for p, c in zip(pattern, n.tolist(), strict=True):
                    seen[p.tobytes()] = seen.get(p.tobytes(), 0) + c
        yield pa.record_batch([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["votes", "n"])

    body = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = body.mapInArrow(count, "votes binary, n long").groupBy("votes").agg(F.sum("n").alias("n")).collect()
    rows.sort(key=lambda r: bytes(r["votes"]))
    votes = np.asarray([np.frombuffer(r["votes"], np.int8) for r in rows]).reshape(-1, len(LABELLERS))
    accuracies, chance, bad_share = estimate(votes, np.asarray([r["n"] for r in rows], dtype=float), spec.rounds)
    patterns = {bytes(r["votes"]): float(q) for r, q in zip(rows, chance, strict=True)}

    unseen = 1 - bad_share

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch.column(0)):
                row, feature, value = hashed_features(data, offsets, spec.bits)
                cut = np.searchsorted(row, np.arange(hi - lo + 1))
                labels = [patterns.get(v.tobytes(), unseen) for v in vote_chunk(data, offsets)]
                yield pa.record_batch(
                    [
                        pa.array(labels),
                        pa.array([feature[a:b].astype(np.int32).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
                        pa.array([value[a:b].astype(np.float32).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
                    ],
                    names=["label", "feature", "value"],
                )

    # the hash of the sample's last document, found without the texts
    order = F.xxhash64(F.lit(spec.seed), "text")
    edge = body.select(order.alias("o")).orderBy("o").limit(spec.sample).agg(F.max("o")).first()[0]
    if edge is None:
        return QualityModel(accuracies, bad_share, patterns, np.zeros(1 << spec.bits), 0.0, spec)
    # copies of one text have one hash; the sample has each text once
    chosen = body.where(order <= edge).dropDuplicates(["text"])
    got = chosen.mapInArrow(extract, "label double, feature binary, value binary").toPandas()
    row = np.repeat(np.arange(len(got)), [len(x) // 4 for x in got["feature"]])
    feature = np.frombuffer(b"".join(got["feature"]), np.int32).astype(np.int64)
    value = np.frombuffer(b"".join(got["value"]), np.float32).astype(float)
    weights, bias = fit(row, feature, value, got["label"].to_numpy(), spec)
    return QualityModel(accuracies, bad_share, patterns, weights, bias, spec)


def classify(docs: DataFrame, spec: ClassifierSpec = ClassifierSpec(), text: str = "text", key: str = "doc_id", model: QualityModel | None = None) -> DataFrame:
    """(doc_id, n_votes, weak_good, score, kept), a row per row of docs.

    weak_good is the label model's posterior chance of good from the votes, n_votes how many
    labellers spoke, score the linear scorer's chance of good, kept whether score reaches
    the threshold.

    Null and empty texts have no features and get the scorer's bias.  Texts of any length
    count whole.  Repeated rows get the same score.  No rows give no rows; other columns
    are not read.  A constant vote of one labeller leaves its accuracy near the start.
    """
    spark = docs.sparkSession
    model = model or train(docs, spec, text)
    shared = spark.sparkContext.broadcast((model.weights, model.patterns))  # 2 ** bits weights, 2 ** 10 patterns at most
    bias, bits, threshold, unseen = model.bias, model.spec.bits, model.spec.threshold, 1 - model.bad_share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, patterns = shared.value
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch.column(1)):
                votes = vote_chunk(data, offsets)
                score = linear_score(data, offsets, weights, bias, bits)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array((votes != ABSTAIN).sum(1).astype(np.int32)),
                        pa.array([patterns.get(v.tobytes(), unseen) for v in votes]),
                        pa.array(score),
                        pa.array(score >= threshold),
                    ],
                    names=["doc_id", "n_votes", "weak_good", "score", "kept"],
                )

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n_votes int, weak_good double, score double, kept boolean")
