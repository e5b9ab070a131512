"""Candidate pairs by shared keys instead of all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.config import MAX_BLOCK
from tessera.functions.text import prefix_key, soundex_key, sorted_tokens


def key_structs(lat: str = "lat", phon: str | None = "phon", soundex: bool = False) -> Column:
    """array<struct<key_type, key>> of a name: sorted tokens, phonetic, prefix and soundex keys.

    phon None leaves the phonetic key out.  An empty name has no keys.
    """
    made = [("sorted", sorted_tokens(lat)), ("pref", prefix_key(lat))]
    made += [("phon", F.col(phon))] if phon else []
    made += [("sdx", soundex_key(lat))] if soundex else []
    structs = F.array(*[F.struct(F.lit(t).alias("key_type"), k.alias("key")) for t, k in made])
    return F.when(F.length(lat) > 0, F.filter(structs, lambda x: x["key"].isNotNull() & (x["key"] != ""))).otherwise(F.array().cast("array<struct<key_type:string,key:string>>"))


def blocking_keys(names: DataFrame, name_id: str = "name_id", lat: str = "lat", phon: str | None = "phon", soundex: bool = False) -> DataFrame:
    """(key_type, key, name_id) rows; names are distinct."""
    keys = names.select(F.col(name_id).alias("name_id"), F.explode(key_structs(lat, phon, soundex)).alias("k"))
    return keys.select("k.key_type", "k.key", "name_id")


def block_sizes(keys: DataFrame) -> DataFrame:
    """(key_type, key, n)."""
    return keys.groupBy("key_type", "key").agg(F.count("*").alias("n"))


def candidate_pairs(keys: DataFrame, max_block: int = MAX_BLOCK) -> DataFrame:
    """(src < dst), each once: names that share a key of at most max_block names.

    Oversize keys go before anything is paired, by a count that is aggregated before its
    shuffle, so a block that is collected has max_block ids at most, however common a key is.
    """
    sizes = block_sizes(keys).where((F.col("n") > 1) & (F.col("n") <= max_block)).select("key_type", "key")
    blocks = keys.join(sizes, ["key_type", "key"]).groupBy("key_type", "key").agg(F.array_sort(F.collect_list("name_id")).alias("ids"))
    pairs = F.flatten(
        F.transform("ids", lambda a, i: F.transform(F.slice("ids", i + 2, F.size("ids")), lambda b: F.struct(a.alias("src"), b.alias("dst"))))
    )
    return blocks.select(F.explode(pairs).alias("p")).select("p.src", "p.dst").where("src < dst").distinct()


def reduction(n_names: Column, n_pairs: Column) -> Column:
    """1 - candidates / all pairs."""
    return 1 - n_pairs / F.nullif(n_names * (n_names - 1) / 2, F.lit(0.0))
