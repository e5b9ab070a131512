"""Eleven features of a pair of names.

Five are string kernels, computed in one Arrow UDF for a batch of pairs at a time; the rest
are native expressions.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import initials, n_tokens

#: Order of the features in vectors and models.
FEATURES = ("ratio", "token_sort", "token_set", "partial", "jaro_winkler", "levenshtein", "len_diff", "tok_diff", "same_phon", "same_init", "min_tokens")


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, one bit per character of a (Hyyro, 2004)."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    rows = full
    for ch in b:
        hit = rows & where.get(ch, 0)
        rows = ((rows + hit) | (rows - hit)) & full
    return len(a) - rows.bit_count()


def ratio(a: str, b: str) -> float:
    """2 * LCS / (len(a) + len(b)); two empty strings are equal."""
    if a == b:
        return 1.0
    total = len(a) + len(b)
    return 2 * common_subsequence(a, b) / total if total else 1.0


def _sorted(s: str) -> str:
    return " ".join(sorted(s.split()))


def token_sort(a: str, b: str) -> float:
    return ratio(_sorted(a), _sorted(b))


def token_set(a: str, b: str) -> float:
    """Best ratio of the common tokens alone and with each side's rest; 0 if a side is empty."""
    one, two = set(a.split()), set(b.split())
    if not one or not two:
        return 0.0
    both = " ".join(sorted(one & two))
    rest_one, rest_two = " ".join(sorted(one - two)), " ".join(sorted(two - one))
    if both and (not rest_one or not rest_two):
        return 1.0
    if not both:
        return ratio(rest_one, rest_two)
    left, right = f"{both} {rest_one}", f"{both} {rest_two}"
    # the common part is a start of both, so these ratios need no alignment
    part = max(2 * len(both) / (len(both) + len(x)) for x in (left, right))
    shared = len(both) + 1 + common_subsequence(rest_one, rest_two)
    return max(part, 2 * shared / (len(left) + len(right)))


def partial(a: str, b: str) -> float:
    """Best ratio of the shorter string with a stretch of the longer one of its length; at the
    ends the stretch may be shorter.
    """
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not short:
        return 1.0 if not long else 0.0
    if short in long:
        return 1.0
    m, n = len(short), len(long)
    letters = set(short)
    best = 0.0
    # a best stretch begins or ends with a character of the short string
    for end in range(1, n + m):
        lo, hi = max(0, end - m), min(n, end)
        edge = long[hi - 1] if hi == end else long[lo]
        if lo >= hi or edge not in letters:
            continue
        if 2 * min(m, hi - lo) / (m + hi - lo) > best:
            best = max(best, ratio(short, long[lo:hi]))
    if m == n:
        best = max(best, ratio(a, b))
    return best


def jaro_winkler(a: str, b: str) -> float:
    """Jaro similarity, raised for a common start of up to four characters if over 0.7."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    free = [True] * len(b)
    found = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == ch:
                free[j] = False
                found.append(ch)
                break
    m = len(found)
    if not m:
        return 0.0
    other = [ch for ch, unused in zip(b, free, strict=True) if not unused]
    moved = sum(x != y for x, y in zip(found, other, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    if jaro <= 0.7:
        return jaro
    start = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, len(a), len(b)))
    return jaro + 0.1 * start * (1 - jaro)


#: Names up to this long are compared in batches, one bit of a word per character; pairs with
#: a longer one are compared one by one.
WORD_BITS = 63
#: Pairs that are worked on at once, so that their tables stay near the processor.
LOT = 2_048
# what no character is, for the places behind the end of a name
_NO_LEFT, _NO_RIGHT = np.uint32(0xFFFFFFFF), np.uint32(0xFFFFFFFE)


class Batch:
    """Pairs of names as matrices of code points; a, b: (pairs, length), la, lb: lengths."""

    def __init__(self, left: list[str], right: list[str]):
        (self.a, self.la), (self.b, self.lb) = self._codes(left, _NO_LEFT), self._codes(right, _NO_RIGHT)

    @staticmethod
    def _codes(names: list[str], nothing: np.uint32) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, names), np.int64, len(names))
        width = max(int(sizes.max(initial=0)), 1)
        codes = np.array(names, dtype=f"U{width}").view(np.uint32).reshape(len(names), width).copy()
        codes[np.arange(width) >= sizes[:, None]] = nothing
        return codes, sizes

    def turned(self, which: np.ndarray) -> Batch:
        """The pairs with left and right exchanged where which says so."""
        out, width = Batch.__new__(Batch), max(self.a.shape[1], self.b.shape[1])
        a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1])), constant_values=v) for x, v in ((self.a, _NO_LEFT), (self.b, _NO_RIGHT)))
        out.a, out.b = np.where(which[:, None], b, a), np.where(which[:, None], a, b)
        out.la, out.lb = np.where(which, self.lb, self.la), np.where(which, self.la, self.lb)
        places = np.arange(width)
        out.a[places >= out.la[:, None]], out.b[places >= out.lb[:, None]] = _NO_LEFT, _NO_RIGHT
        return out

    def hits(self, j: int) -> np.ndarray:
        """For each pair the places of a, as bits, that hold character j of b."""
        packed = np.packbits(self.a == self.b[:, j : j + 1], axis=1, bitorder="little")
        out = np.zeros((len(packed), 8), np.uint8)
        out[:, : packed.shape[1]] = packed
        return out.view(np.uint64)[:, 0]

    def full(self) -> np.ndarray:
        return (np.uint64(1) << self.la.astype(np.uint64)) - np.uint64(1)

    def common(self) -> np.ndarray:
        """Lengths of the longest common subsequences."""
        full = rows = self.full()
        for j in range(self.b.shape[1]):
            hit = rows & self.hits(j)
            rows = ((rows + hit) | (rows - hit)) & full
        return self.la - np.bitwise_count(rows)

    def ratio(self) -> np.ndarray:
        total = self.la + self.lb
        return np.where(total > 0, 2 * self.common() / np.maximum(total, 1), 1.0)

    def partial(self) -> np.ndarray:
        """partial() of each pair: from every place of the longer name the shorter one is run
        along, and read where the stretch is as long as it or ends with the name.
        """
        pairs = self.turned(self.la > self.lb)
        m, n, full = pairs.la, pairs.lb, pairs.full()
        hits = [pairs.hits(j) for j in range(int(n.max(initial=0)))]
        best = np.zeros(len(m))
        for i in range(len(hits)):
            rows = full
            for k in range(min(int(m.max(initial=0)), len(hits) - i)):
                hit = rows & hits[i + k]
                rows = np.where(k < m, ((rows + hit) | (rows - hit)) & full, rows)
                whole = (k < m) & (i + k < n) & ((k == m - 1) | (i + k == n - 1) | (i == 0))
                best = np.where(whole, np.maximum(best, 2 * (m - np.bitwise_count(rows)) / (m + k + 1)), best)
        return np.where(m > 0, best, (n == 0).astype(float))

    def jaro_winkler(self) -> np.ndarray:
        a, b, la, lb = self.a, self.b, self.la, self.lb
        pair, place = np.arange(len(a)), np.arange(b.shape[1])
        reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)[:, None]
        free, found = place < lb[:, None], np.zeros(a.shape, bool)
        for i in range(a.shape[1]):
            near = free & (b == a[:, i : i + 1]) & (np.abs(place - i) <= reach)
            first = near.argmax(1)
            found[:, i] = near[pair, first]
            free[pair[found[:, i]], first[found[:, i]]] = False
        used = ~free & (place < lb[:, None])
        m = found.sum(1)
        front = lambda codes, which: np.take_along_axis(codes, np.argsort(~which, axis=1, kind="stable"), 1)
        width = min(a.shape[1], b.shape[1])
        moved = ((front(a, found)[:, :width] != front(b, used)[:, :width]) & (np.arange(width) < m[:, None])).sum(1) // 2
        some = np.maximum(m, 1)
        jaro = np.where(m > 0, (m / np.maximum(la, 1) + m / np.maximum(lb, 1) + (m - moved) / some) / 3, 0.0)
        start = np.cumprod(a[:, : min(4, width)] == b[:, : min(4, width)], axis=1).sum(1)
        score = np.where(jaro > 0.7, jaro + 0.1 * start * (1 - jaro), jaro)
        return np.where((la == 0) & (lb == 0), 1.0, score)


def _lots(left: pd.Series, right: pd.Series, alone: Callable[[str, str], float], together: Callable[[list[str], list[str]], np.ndarray]) -> np.ndarray:
    """together() of the pairs of short names, by LOT, and alone() of the others."""
    left, right = left.to_numpy(dtype=object), right.to_numpy(dtype=object)
    size = np.fromiter((max(len(a), len(b)) for a, b in zip(left, right, strict=True)), np.int64, len(left))
    out = np.zeros(len(left))
    # pairs of like lengths together, since a lot is as wide as its longest name
    short = np.flatnonzero(size <= WORD_BITS)
    short = short[np.argsort(size[short], kind="stable")]
    for lo in range(0, len(short), LOT):
        at = short[lo : lo + LOT]
        out[at] = together(left[at].tolist(), right[at].tolist())
    for i in np.flatnonzero(size > WORD_BITS).tolist():
        out[i] = alone(left[i], right[i])
    return out


def _token_sets(left: list[str], right: list[str]) -> np.ndarray:
    known: dict[str, frozenset[str]] = {}

    def words(s: str) -> frozenset[str]:
        found = known.get(s)
        if found is None:
            found = known[s] = frozenset(s.split())
        return found

    out, open_at, rests, common = np.zeros(len(left)), [], ([], []), []
    for i, (a, b) in enumerate(zip(map(words, left), map(words, right), strict=True)):
        both = a & b
        if not a or not b:
            continue
        if both and (len(both) == len(a) or len(both) == len(b)):
            out[i] = 1.0
            continue
        open_at.append(i)
        common.append(sum(map(len, both)) + len(both) - 1 if both else 0)  # joined by spaces
        rests[0].append(" ".join(sorted(a - both)))
        rests[1].append(" ".join(sorted(b - both)))
    if open_at:
        pairs, head = Batch(*rests), np.asarray(common)
        shared = np.where(head > 0, head + 1, 0)  # the common words, and the space behind them
        one, two = pairs.la + shared, pairs.lb + shared
        along = np.where(head > 0, 2 * head / (head + np.minimum(one, two)), 0.0)
        out[open_at] = np.maximum(along, 2 * (shared + pairs.common()) / (one + two))
    return out


def _by(kernel: Callable[[Batch], np.ndarray]) -> Callable[[list[str], list[str]], np.ndarray]:
    return lambda left, right: kernel(Batch(left, right))


def ratios(left: pd.Series, right: pd.Series) -> np.ndarray:
    return _lots(left, right, ratio, _by(Batch.ratio))


def token_sorts(left: pd.Series, right: pd.Series) -> np.ndarray:
    words = {x: _sorted(x) for x in {*left, *right}}  # once per name
    return ratios(left.map(words), right.map(words))


def token_sets(left: pd.Series, right: pd.Series) -> np.ndarray:
    return _lots(left, right, token_set, _token_sets)


def partials(left: pd.Series, right: pd.Series) -> np.ndarray:
    return _lots(left, right, partial, _by(Batch.partial))


def jaro_winklers(left: pd.Series, right: pd.Series) -> np.ndarray:
    return _lots(left, right, jaro_winkler, _by(Batch.jaro_winkler))


KERNELS = (ratios, token_sorts, token_sets, partials, jaro_winklers)


@F.pandas_udf(T.StructType([T.StructField(k, T.DoubleType()) for k in FEATURES[:5]]))
def kernels(left: pd.Series, right: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({k: f(left, right) for k, f in zip(FEATURES, KERNELS, strict=False)})


@F.pandas_udf(T.DoubleType())
def token_sort_score(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series(token_sorts(left, right))


@F.pandas_udf(T.DoubleType())
def token_set_score(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series(token_sets(left, right))


@F.pandas_udf(T.DoubleType())
def jaro_winkler_score(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series(jaro_winklers(left, right))


def levenshtein_score(a: Column | str, b: Column | str) -> Column:
    """1 - edit distance / longer length; 1 for two empty strings."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.coalesce(1 - F.levenshtein(a, b) / F.nullif(F.greatest(F.length(a), F.length(b)), F.lit(0)), F.lit(1.0))


def native_features(left: str, right: str) -> dict[str, Column]:
    a, b = F.col(left), F.col(right)
    return {
        "levenshtein": levenshtein_score(a, b),
        "len_diff": F.abs(F.length(a) - F.length(b)) / (F.length(a) + F.length(b) + 1),
        "tok_diff": F.abs(n_tokens(a) - n_tokens(b)).cast("double"),
        "same_init": (initials(a) == initials(b)).cast("double"),
        "min_tokens": F.least(n_tokens(a), n_tokens(b)).cast("double"),
    }


def pair_features(pairs: DataFrame, left: str = "left", right: str = "right", left_phon: str = "left_phon", right_phon: str = "right_phon") -> DataFrame:
    """pairs with the eleven features as doubles.

    The phonetic keys are columns of pairs, computed once per name and not once per pair.
    """
    df = pairs.withColumn("_k", kernels(left, right))
    df = df.withColumns({k: F.col(f"_k.{k}") for k in FEATURES[:5]}).drop("_k")
    return df.withColumns(native_features(left, right) | {"same_phon": (F.col(left_phon) == F.col(right_phon)).cast("double")})
