"""Candidate generation: token blocking with a purge of frequent tokens, first-token blocking, recall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T

FIELDS = ("name", "address")


def block_tokens(entities: DataFrame, fields: tuple[str, ...] = FIELDS, min_len: int = 3) -> DataFrame:
    """A row for each token occurrence of ``entities(source, entity_id, business_name, business_address, country)``.

    A null country meets no other, so those rows are dropped here. Columns: source, country, field, token, entity_id.
    """
    texts = {"name": T.block_name(F.col("business_name")), "address": T.block_address(F.col("business_address"))}
    held = entities.filter(T.given(F.col("country")).isNotNull())

    def tagged(field: str) -> Column:
        return F.transform(T.tokens(texts[field]), lambda t: F.struct(F.lit(field).alias("field"), t.alias("token")))

    each = F.explode(F.flatten(F.array(*map(tagged, fields))))
    return held.select("source", "country", "entity_id", each.alias("t")).select("source", "country", "t.field", "t.token", "entity_id").filter(F.char_length("token") >= min_len)


def token_frequency(tokens: DataFrame) -> DataFrame:
    """Occurrences of each token within its source, country and field."""
    return tokens.groupBy("source", "country", "field", "token").agg(F.count("*").alias("freq"))


def purge(tokens: DataFrame, max_freq: int) -> DataFrame:
    """Tokens that occur at most ``max_freq`` times within source, country and field."""
    rare = token_frequency(tokens).filter(F.col("freq") <= max_freq)
    return tokens.join(rare, ["source", "country", "field", "token"], "left_semi")


def rare_lists(tokens: DataFrame, max_freq: int) -> DataFrame:
    """(source, country, field, token, ids) of the tokens that ``purge`` keeps.

    A token's first max_freq + 1 occurrences tell whether it is rare. The limit is taken in each input partition before the
    shuffle, so a token that every record has costs a few rows of each, and no list is longer.
    """
    key = ["source", "country", "field", "token"]
    nth = F.row_number().over(W.partitionBy(*key).orderBy("entity_id"))
    first = tokens.withColumn("nth", nth).filter(F.col("nth") <= max_freq + 1)
    return first.groupBy(*key).agg(F.collect_list("entity_id").alias("ids")).filter(F.size("ids") <= max_freq)


def candidates(entities: DataFrame, max_freq: int = 25, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Distinct pairs (s1_id, cand_id) of one country that share a rare token in one field.

    Entities are read once; the token join is a grouping of short lists, at most max_freq ids of each source.
    """
    lists = rare_lists(block_tokens(entities, fields), max_freq)
    one = F.col("source") == "S1"
    sides = lists.groupBy("country", "field", "token").agg(F.flatten(F.collect_list(F.when(one, F.col("ids")))).alias("a"), F.flatten(F.collect_list(F.when(~one, F.col("ids")))).alias("b"))
    pairs = F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: F.struct(x.alias("s1_id"), y.alias("cand_id")))))
    return sides.filter((F.size("a") > 0) & (F.size("b") > 0)).select(F.explode(pairs).alias("p")).select("p.s1_id", "p.cand_id").distinct()


def grouped(s1: DataFrame, pairs: DataFrame, *also: str) -> DataFrame:
    """One row for each S1 row, candidates sorted and comma-joined, empty if it has none; with the columns ``also`` of S1."""
    lists = pairs.groupBy("s1_id").agg(F.array_join(F.sort_array(F.collect_set("cand_id")), ",").alias("candidate_entity_ids"))
    joined = s1.select(F.col("entity_id").alias("source1_entity_id"), *also).join(lists, F.col("source1_entity_id") == F.col("s1_id"), "left")
    return joined.select(*also, "source1_entity_id", F.coalesce("candidate_entity_ids", F.lit("")).alias("candidate_entity_ids"))


def country_stats(s1: DataFrame, pairs: DataFrame) -> DataFrame:
    """Entities with candidates and pairs, for each country of S1."""
    many = pairs.groupBy("s1_id").agg(F.count("*").alias("n"))
    held = s1.filter("country is not null").select(F.col("entity_id").alias("s1_id"), "country").join(many, "s1_id", "left")
    return held.groupBy("country").agg(F.count_if(F.col("n") > 0).alias("entities_with_candidates"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_pairs"))


def first_token(s1: DataFrame, targets: DataFrame, bucket: int = 10, limit: int = 5000) -> DataFrame:
    """Pairs by the first token of the cleaned name; each token keeps its first ``bucket`` targets in the order of ``ord``.

    Only the first ``limit`` entities of S1 that have a hit get candidates. The order among hits is that of ``ord``: a running
    count by ranges would be needed beyond one task's rows, but the limit makes it a bounded top-k.
    """
    key = F.get(F.split(T.clean(F.col("business_name")), " "), 0)
    held = targets.select("ord", F.col("entity_id").alias("cand_id"), key.alias("token")).filter("token <> ''")
    held = held.withColumn("nth", F.row_number().over(W.partitionBy("token").orderBy("ord", "cand_id"))).filter(F.col("nth") <= bucket)
    asking = s1.select("ord", F.col("entity_id").alias("s1_id"), key.alias("token")).filter("token <> ''")
    hit = asking.join(held.select("token").distinct(), "token", "left_semi").orderBy("ord", "s1_id").limit(limit)
    return hit.select("s1_id", "token").join(held.select("token", "cand_id"), "token").select("s1_id", "cand_id")


def mock_candidates(s1: DataFrame, s2: DataFrame | None, s3: DataFrame, limit: int = 5000, bucket: int = 10, most: tuple[int, int] = (100_000, 150_000)) -> DataFrame:
    """A grouped candidate table by first tokens: every row of ``s1`` in the order of ``ord``, blank ids aside.

    Targets are the first ``most[1]`` entities of S3, then the first ``most[0]`` of S2, in file order; a token keeps its first ``bucket``
    of them. An id in both tables keeps its place in S3 and has the name that S2 gives. The first ``limit`` rows of S1 with a hit get
    candidates, the others none. Columns: ord, source1_entity_id, candidate_entity_ids.
    """
    key = F.get(F.split(T.clean(F.col("business_name")), " "), 0)

    def first(table: DataFrame, n: int, of: int) -> DataFrame:
        return table.orderBy("ord", "entity_id").limit(n).select("entity_id", F.struct(F.lit(of).alias("of"), F.col("ord").alias("ord")).alias("place"), key.alias("token"), F.lit(of).alias("of"))

    held = first(s3, most[1], 0)
    if s2 is not None:
        held = held.unionByName(first(s2, most[0], 1))
    held = held.groupBy("entity_id").agg(F.min("place").alias("place"), F.max_by("token", "of").alias("token")).filter("token <> ''")
    held = held.withColumn("nth", F.row_number().over(W.partitionBy("token").orderBy("place", "entity_id"))).filter(F.col("nth") <= bucket)
    lists = held.groupBy("token").agg(F.sort_array(F.collect_list(F.struct("nth", "entity_id"))).alias("ids"))
    lists = lists.select("token", F.array_join(F.transform("ids", lambda x: x["entity_id"]), ",").alias("ids"))
    asking = s1.select("ord", F.trim("entity_id").alias("s1_id"), key.alias("token")).filter("s1_id <> ''")
    hits = asking.join(lists.select("token"), "token", "left_semi").orderBy("ord", "s1_id").limit(limit)
    # the limit's last row is the border: what stands before it and has a hit gets candidates
    last = hits.agg(F.max(F.struct("ord", "s1_id")).alias("last"))
    rows = asking.join(lists, "token", "left").join(F.broadcast(last))  # a single row
    given = F.struct("ord", "s1_id") <= F.col("last")
    return rows.select("ord", F.col("s1_id").alias("source1_entity_id"), F.when(given & F.col("ids").isNotNull(), F.col("ids")).otherwise("").alias("candidate_entity_ids"))


def recall(truth: DataFrame, pairs: DataFrame) -> DataFrame:
    """Recall ceiling of candidate pairs, as one row. ``truth(s1_id, target_id)``; recall is 1 without true links."""
    found = truth.join(pairs, (truth.s1_id == pairs.s1_id) & (truth.target_id == pairs.cand_id), "left_semi").agg(F.count("*").alias("found_links"))
    links = truth.agg(F.count("*").alias("true_links"))
    many = pairs.groupBy("s1_id").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_candidates"), F.count("*").alias("entities"))
    row = found.join(F.broadcast(links)).join(F.broadcast(many))  # three single rows
    return row.select(
        "true_links",
        "found_links",
        F.when(F.col("true_links") == 0, 1.0).otherwise(F.try_divide("found_links", "true_links")).alias("recall"),
        "total_candidates",
        (F.col("total_candidates") / F.greatest(F.col("entities"), F.lit(1))).alias("avg_candidates"),
    )
