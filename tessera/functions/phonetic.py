"""Phonetic keys by the Metaphone rules (Philips, 1990)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import tokens

_VOWELS = set("AEIOU")
_FRONT = set("EIY")
_PLAIN = {"F": "F", "J": "J", "L": "L", "M": "M", "N": "N", "R": "R", "Q": "K", "V": "F", "Z": "S"}


def metaphone(word: str) -> str:
    """The Metaphone code of an ASCII word; other characters than letters are silent."""
    w = "".join(ch for ch in word.upper() if ch.isascii() and ch.isalpha())
    if not w:
        return ""
    if w[:2] in ("KN", "GN", "PN", "WR", "AE"):
        w = w[1:]
    elif w[0] == "X":
        w = "S" + w[1:]
    elif w[:2] == "WH":
        w = "W" + w[2:]
    out = []
    last = len(w) - 1
    skip = False
    for i, ch in enumerate(w):
        if skip:
            skip = False
            continue
        before, after, then = w[i - 1] if i else "", w[i + 1] if i < last else "", w[i + 2] if i + 1 < last else ""
        if ch == before and ch != "C":
            continue
        if ch in _VOWELS:
            if i == 0:
                out.append(ch)
        elif ch in _PLAIN:
            out.append(_PLAIN[ch])
        elif ch == "B":
            if not (before == "M" and i == last):
                out.append("B")
        elif ch == "C":
            if after == "I" and then == "A":
                out.append("X")
            elif after in _FRONT:
                if before != "S":
                    out.append("S")
            elif after == "H":
                out.append("K" if before == "S" or (i == 0 and then not in _VOWELS and then) else "X")
                skip = True
            else:
                out.append("K")
        elif ch == "D":
            if after == "G" and then in _FRONT and then:
                out.append("J")
                skip = True
            else:
                out.append("T")
        elif ch == "G":
            if after == "H" and not (i + 1 == last or then in _VOWELS):
                continue  # silent before H and a consonant
            if after == "N" and (i + 1 == last or w[i + 1 :] == "NED"):
                continue
            if before == "D" and after in _FRONT and after:
                continue
            out.append("J" if after in _FRONT and after and before != "G" else "K")
        elif ch == "H":
            if after in _VOWELS and after and before not in set("CSPTG"):
                out.append("H")
        elif ch == "K":
            if before != "C":
                out.append("K")
        elif ch == "P":
            if after == "H":
                out.append("F")
                skip = True
            else:
                out.append("P")
        elif ch == "S":
            if after == "H":
                out.append("X")
                skip = True
            elif after == "I" and then in ("O", "A"):
                out.append("X")
            else:
                out.append("S")
        elif ch == "T":
            if after == "I" and then in ("O", "A"):
                out.append("X")
            elif after == "H":
                out.append("0")
                skip = True
            elif not (after == "C" and then == "H"):
                out.append("T")
        elif ch in "WY":
            if after in _VOWELS and after:
                out.append(ch)
        elif ch == "X":
            out.append("KS")
    return "".join(out)


def token_code(token: str) -> str | None:
    """Metaphone code, or the first four characters if there is none; null if not ASCII."""
    if not token.isascii():
        return None
    return metaphone(token) or token[:4]


@F.pandas_udf(T.StringType())
def token_codes(s: pd.Series) -> pd.Series:
    return s.map(token_code)


@F.pandas_udf(T.StringType())
def _key(s: pd.Series) -> pd.Series:
    seen: dict[str, str | None] = {}

    def code(t: str) -> str | None:
        if t not in seen:
            seen[t] = token_code(t)
        return seen[t]

    return s.map(lambda x: None if x is None else " ".join(sorted(c for c in map(code, x.split()) if c is not None)))


def phonetic_key(c: Column | str) -> Column:
    """Codes of the tokens, sorted and joined; for distinct values, where most tokens recur."""
    return _key(F.col(c) if isinstance(c, str) else c)


def with_phonetic_key(df: DataFrame, column: str = "lat", out: str = "phon") -> DataFrame:
    """df with the phonetic key, coding each distinct token of the table once.

    One row per distinct value goes through the joins, not one per row.
    """
    values = df.select(F.col(column).alias("_v")).distinct()
    exploded = values.select("_v", F.explode(tokens("_v")).alias("_t"))
    codes = exploded.select("_t").distinct().withColumn("_c", token_codes("_t"))
    keys = exploded.join(codes, "_t").groupBy("_v").agg(F.array_join(F.array_sort(F.collect_list("_c")), " ").alias(out))
    joined = df.drop(out).join(keys, df[column] == keys["_v"], "left").drop("_v")
    return joined.withColumn(out, F.coalesce(out, F.lit("")))
