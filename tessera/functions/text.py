"""Names as text: normalisation, Latin spelling, keys and labels, as column expressions.

Only the Unicode compatibility form needs Python; it is an Arrow UDF, to be run on distinct
values (on_distinct).  All else stays inside the JVM.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import tables


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@F.pandas_udf(T.StringType())
def compatible(s: pd.Series) -> pd.Series:
    """Unicode compatibility composition (NFKC); null stays null."""
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFKC", x))


def on_distinct(df: DataFrame, column: str, derive: Callable[[Column], dict[str, Column]]) -> DataFrame:
    """df with derived columns that are computed once per distinct value and joined back.

    Null values derive like the empty string.  A derived column replaces one of its name.
    """
    value = F.coalesce(F.col(column).cast("string"), F.lit(""))
    names = derive(F.col("_value"))
    small = df.select(value.alias("_value")).distinct().withColumns(names)
    return df.drop(*names).withColumn("_value", value).join(small, "_value", "left").drop("_value")


def _squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "[\\s\\x1c-\\x1f]+", " "))


def _letters_only(c: Column) -> Column:
    # letters, digits and _ by Unicode category; combining marks are neither
    return _squeeze(F.regexp_replace(c, "[^\\p{L}\\p{N}_\\s]", " "))


def normalize(c: Column | str) -> Column:
    """Lower case, composed, without punctuation, single spaces; null gives ''."""
    low = F.lower(compatible(F.coalesce(_col(c).cast("string"), F.lit(""))))
    return _letters_only(F.translate(low, "ё«»", "е  "))


def normalize_light(c: Column | str) -> Column:
    """Lower case and single spaces for letters and digits, without composition."""
    return _letters_only(F.lower(F.coalesce(_col(c).cast("string"), F.lit(""))))


def translit(c: Column | str) -> Column:
    """Latin spelling: the letter tables, ASCII as it is, other letters without diacritics if
    that leaves ASCII, else a space.
    """
    out = _col(c)
    for letter, spelled in tables.LETTERS.items():
        if len(spelled) > 1:
            out = F.replace(out, F.lit(letter), F.lit(spelled))
    out = F.translate(out, *tables.single_letters())
    return _squeeze(F.regexp_replace(out, "[^\\x00-\\x7F]", " "))


def prep(c: Column | str) -> Column:
    """The comparison key: normalised and spelled in Latin."""
    return translit(normalize(c))


def tokens(c: Column | str) -> Column:
    return F.filter(F.split(_col(c), "\\s+"), lambda t: t != "")


def n_tokens(c: Column | str) -> Column:
    return F.size(tokens(c))


def sorted_tokens(c: Column | str) -> Column:
    return F.array_join(F.array_sort(tokens(c)), " ")


def initials(c: Column | str) -> Column:
    return F.array_join(F.transform(tokens(c), lambda t: F.substring(t, 1, 1)), "")


def prefix_key(c: Column | str, size: int = 4) -> Column:
    """First letters of the two smallest tokens joined by |; null with fewer than two."""
    two = F.slice(F.array_sort(tokens(c)), 1, 2)
    return F.when(F.size(two) == 2, F.array_join(F.transform(two, lambda t: F.substring(t, 1, size)), "|"))


def soundex_key(c: Column | str) -> Column:
    """Soundex of each token, sorted; a token that begins with no letter stays as it is."""
    return F.array_join(F.array_sort(F.transform(tokens(c), F.soundex)), " ")


def strip_digits(c: Column | str) -> Column:
    return _squeeze(F.regexp_replace(_col(c), "\\p{Nd}+", " "))


def _form_of(token: Column) -> Column:
    out = None
    for form, words in tables.LEGAL_FORMS.items():
        hit = token.isin(words)
        out = F.when(hit, form) if out is None else out.when(hit, form)
    return out


def legal_form(c: Column | str) -> Column:
    """The form of the first token that names one, else null."""
    return F.get(F.filter(F.transform(tokens(c), _form_of), lambda f: f.isNotNull()), F.lit(0))


def without_legal_form(c: Column | str) -> Column:
    return F.array_join(F.filter(tokens(c), lambda t: _form_of(t).isNull()), " ")


def script_label(c: Column | str, profile: bool = False) -> Column:
    """latin, cyrillic, ..., mixed:a+b, or other; profile knows one script more."""
    c = _col(c)
    scripts = tables.PROFILE_SCRIPTS if profile else tables.SCRIPTS
    found = F.array_compact(F.array(*[F.when(c.rlike(f"[{scripts[k]}]"), k) for k in sorted(scripts)]))
    return F.when(F.size(found) == 0, "other").when(F.size(found) == 1, F.get(found, F.lit(0))).otherwise(F.concat(F.lit("mixed:"), F.array_join(found, "+")))


def has_more_cyrillic(c: Column | str) -> Column:
    return _col(c).rlike(tables.MORE_CYRILLIC_LETTERS)


def name_keys(raw: Column | str, is_company: Column | bool = False) -> dict[str, Column]:
    """All representations of a name but the phonetic one, for on_distinct."""
    company = is_company if isinstance(is_company, Column) else F.lit(is_company)
    norm = normalize(raw)
    lat = translit(F.when(company, without_legal_form(norm)).otherwise(norm))
    return {
        "norm": norm,
        "legal_form": F.when(company, legal_form(norm)),
        "lat": lat,
        "lat_sorted": sorted_tokens(lat),
        "initials": initials(lat),
        "n_tokens": n_tokens(lat),
    }


def safe_name(text: str) -> str:
    """A column name as a file name: runs of other characters become _."""
    return re.sub("[^A-Za-z0-9_]+", "_", text)


def human(n: int) -> str:
    """Thousands separated by spaces."""
    return f"{n:,}".replace(",", " ")
