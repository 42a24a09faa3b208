"""The 21 features of a candidate pair. Entities are prepared once, below the pair join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T

#: The names of the features, in their order.
NAMES = (
    "name_edit_sim", "name_root_edit_sim", "name_token_sort_sim", "name_token_set_sim", "name_jaccard_word", "name_jaccard_char_3gram",
    "name_exact_match", "name_length_diff", "addr_edit_sim", "addr_token_sort_sim", "addr_token_set_sim", "addr_jaccard_word",
    "addr_jaccard_char_3gram", "addr_exact_match", "addr_numeric_exact", "addr_numeric_jaccard", "addr_numeric_has_overlap",
    "country_match", "name_missing", "addr_missing", "country_missing",
)


_TEXTS = ("name", "addr", "country", "root", "name_sorted", "addr_sorted")
_SETS = ("name_words", "name_grams", "addr_words", "addr_grams", "nums")


def prepare(entities: DataFrame) -> DataFrame:
    """entity_id and ``e``: normalized texts, their words in order, and their word, 3-gram and number sets, sorted."""
    base = entities.select("entity_id", T.name(F.col("business_name")).alias("name"), T.address(F.col("business_address")).alias("addr"), T.numbers(F.col("business_address")).alias("nums"), T.country(F.col("country")).alias("country"))
    values = {
        "name": F.col("name"), "addr": F.col("addr"), "country": F.col("country"), "root": T.root(F.col("name")),
        "name_sorted": S.in_order(F.col("name")), "addr_sorted": S.in_order(F.col("addr")),
        "name_words": F.sort_array(T.words(F.col("name"))), "name_grams": T.ngrams(F.col("name")),
        "addr_words": F.sort_array(T.words(F.col("addr"))), "addr_grams": T.ngrams(F.col("addr")),
        "nums": F.sort_array(F.array_distinct(F.coalesce("nums", F.array().cast("array<string>")))),
    }
    return base.select("entity_id", F.struct(*(values[n].alias(n) for n in (*_TEXTS, *_SETS))).alias("e"))


def _empty() -> Column:
    none = F.array().cast("array<string>")
    return F.struct(*(F.lit("").alias(n) for n in _TEXTS), *(none.alias(n) for n in _SETS))


def attach(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """``pairs(s1_id, cand_id)`` with prepared entities ``a`` and ``b``; an unknown id is an entity without any value.

    The features of a pair cost far more than its bytes tell: the last shuffle has as many partitions as the session asks for,
    which the number being given keeps from being put together by size.
    """
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = pairs.join(left.select(F.col("entity_id").alias("s1_id"), F.col("e").alias("a")), "s1_id", "left")
    if not pairs.isStreaming:
        x = x.repartition(n, "cand_id")
    x = x.join(right.select(F.col("entity_id").alias("cand_id"), F.col("e").alias("b")), "cand_id", "left")
    return x.withColumn("a", F.coalesce("a", _empty())).withColumn("b", F.coalesce("b", _empty()))


def _flag(x: Column) -> Column:
    return F.when(x, 1.0).otherwise(0.0)


def columns() -> dict[str, Column]:
    """The features as expressions of ``a`` and ``b``, in their fixed order."""
    a, b = F.col("a"), F.col("b")
    name = (a["name"] != "") & (b["name"] != "")
    addr = (a["addr"] != "") & (b["addr"] != "")
    country = (a["country"] != "") & (b["country"] != "")
    both = (F.size(a["nums"]) > 0) & (F.size(b["nums"]) > 0)
    neither = (F.size(a["nums"]) == 0) & (F.size(b["nums"]) == 0)
    long, short = F.greatest(F.char_length(a["name"]), F.char_length(b["name"])), F.least(F.char_length(a["name"]), F.char_length(b["name"]))

    def where(c: Column, value: Column, other: float = 0.0) -> Column:
        return F.when(c, value).otherwise(other)

    def numeric(value: Column) -> Column:
        return F.when(both, value).when(neither, 0.5).otherwise(0.0)

    values = (
        where(name, S.edit(a["name"], b["name"])),
        where(name, S.edit(a["root"], b["root"])),
        where(name, S.guarded(a["name"], b["name"], S.edit(a["name_sorted"], b["name_sorted"]))),
        where(name, S.guarded(a["name"], b["name"], S.sorted_sets(a["name_words"], b["name_words"]))),
        where(name, S.jaccard(a["name_words"], b["name_words"])),
        where(name, S.jaccard(a["name_grams"], b["name_grams"])),
        where(name, _flag(a["name"] == b["name"])),
        where(name, (long - short) / long, 1.0),
        where(addr, S.edit(a["addr"], b["addr"])),
        where(addr, S.guarded(a["addr"], b["addr"], S.edit(a["addr_sorted"], b["addr_sorted"]))),
        where(addr, S.guarded(a["addr"], b["addr"], S.sorted_sets(a["addr_words"], b["addr_words"]))),
        where(addr, S.jaccard(a["addr_words"], b["addr_words"])),
        where(addr, S.jaccard(a["addr_grams"], b["addr_grams"])),
        where(addr, _flag(a["addr"] == b["addr"])),
        numeric(_flag(a["nums"] == b["nums"])),
        numeric(S.jaccard(a["nums"], b["nums"])),
        numeric(_flag(F.arrays_overlap(a["nums"], b["nums"]))),
        where(country, _flag(a["country"] == b["country"]), 0.5),
        _flag(~name),
        _flag(~addr),
        _flag(~country),
    )
    return dict(zip(NAMES, values, strict=True))


def pair_features(pairs: DataFrame, left: DataFrame, right: DataFrame, names: tuple[str, ...] = NAMES) -> DataFrame:
    """(s1_id, cand_id, features) of candidate pairs, from raw entities of both sides."""
    f = columns()
    return attach(pairs, prepare(left), prepare(right)).select("s1_id", "cand_id", *(f[n].alias(n) for n in names))
