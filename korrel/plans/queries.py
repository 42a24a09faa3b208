"""The registered queries: each an operator on the tables of a data directory."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T
from ..operators import blocking, features, metrics, models, results, training
from ..sources import scratch, tsv
from ..sources.scratch import kept
from . import entities as E

QUERIES: dict = {}
THRESHOLD = 0.5


def query(f):
    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return f


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, x): business names of the fixture, and of parts and customers."""
    b = E.business(spark).select(F.col("entity_id").alias("id"), F.col("business_name").alias("x"))
    p = E.table(spark, sf_dir, "part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"), F.col("p_name").alias("x"))
    c = E.table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_name").alias("x"))
    return b.unionByName(p).unionByName(c)


def _addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = E.business(spark).select(F.col("entity_id").alias("id"), F.col("business_address").alias("x"))
    c = E.table(spark, sf_dir, "supplier").join(E.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return b.unionByName(c.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"), F.concat_ws(" ", F.col("s_suppkey").cast("string"), "s_name", F.lit("Street,"), "n_name").alias("x")))


def _countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = E.business(spark).select(F.col("entity_id").alias("id"), F.col("country").alias("x"))
    return b.unionByName(E.table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"), F.col("n_name").alias("x")))


@query
def q_profile(spark, sf_dir):
    out = None
    for t in ("documents", "part", "supplier"):
        row = tsv.profile(E.table(spark, sf_dir, t), t)
        out = row if out is None else out.unionByName(row)
    return out


@query
def q_preview(spark, sf_dir):
    path = f"{scratch.root(spark)}/preview-{uuid.uuid4().hex}.tsv"
    tsv.write_one(E.table(spark, sf_dir, "part").orderBy("p_partkey").select("p_partkey", "p_name", "p_brand"), path)
    scratch.delete_at_end(spark, path)
    return tsv.preview(tsv.lines(spark, path))


@query
def q_tsv_source(spark, sf_dir):
    """Entities by way of tab-separated files, of which the last row of an id counts."""
    path = f"{scratch.root(spark)}/source-{uuid.uuid4().hex}"
    ents = E.entities(spark, sf_dir).select("entity_id", "business_name", "business_address", "country")
    tsv.write(ents, path)
    scratch.delete_at_end(spark, path)
    return tsv.entities(tsv.lines(spark, path)).select("entity_id", "business_name", "business_address", "country")


@query
def q_combined_lookup(spark, sf_dir):
    """Two sources that share ids: training reads the first one's row, prediction the second one's."""
    ents = E.entities(spark, sf_dir)

    def numbered(source):
        return ents.filter(F.col("source") == source).groupBy(F.concat(F.lit("T-"), (F.col("ord") % 500).cast("string")).alias("entity_id")).agg(F.min("business_name").alias("business_name"))

    two, three = numbered("S2"), numbered("S3")
    training_ = tsv.combined(two, three).withColumnRenamed("business_name", "in_training")
    return training_.join(tsv.combined(two, three, keep="second").withColumnRenamed("business_name", "in_prediction"), "entity_id")


@query
def q_block_mock(spark, sf_dir):
    ents = E.entities(spark, sf_dir)
    return blocking.mock_candidates(E.s1(ents), ents.filter("source = 'S2'"), ents.filter("source = 'S3'")).drop("ord")


@query
def q_load_source(spark, sf_dir):
    raw = E.table(spark, sf_dir, "documents").select(F.concat(F.lit(" S1-"), (F.col("doc_id") % 300).cast("string")).alias("entity_id"), F.concat(F.lit(" "), F.col("source")).alias("business_name"), F.col("lang").alias("country"), F.col("doc_id").alias("ord"))
    return tsv.entities(raw).select("entity_id", "business_name", "business_address", "country")


@query
def q_union_targets(spark, sf_dir):
    ents = E.entities(spark, sf_dir)
    both = ents.filter("source = 'S2'").unionByName(ents.filter("source = 'S3'"))
    return both.select("entity_id", "source", "business_name", "country")


def _truth_table(spark, sf_dir):
    ents = E.entities(spark, sf_dir)
    lists = E.truth(ents).groupBy("s1_id").agg(F.array_join(F.sort_array(F.collect_list("target_id")), " ,").alias("ids"))
    return E.s1(ents).select(F.col("entity_id").alias("source1_entity_id"), "ord").join(lists, F.col("source1_entity_id") == F.col("s1_id"), "left").select("source1_entity_id", F.col("ids").alias("matched_entity_ids"), "ord")


@query
def q_truth_long(spark, sf_dir):
    return tsv.exploded(tsv.truth(_truth_table(spark, sf_dir)))


@query
def q_load_pairs(spark, sf_dir):
    ents = E.entities(spark, sf_dir)
    table = blocking.grouped(E.s1(ents), blocking.candidates(ents, 5)).withColumn("candidate_entity_ids", F.concat("candidate_entity_ids", F.lit(",S1-0,, "), "candidate_entity_ids"))
    return tsv.pairs(table)


@query
def q_clean_text(spark, sf_dir):
    docs = E.table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").cast("string").alias("id"), F.md5(T.clean(F.col("text"))).alias("cleaned_md5")).unionByName(_names(spark, sf_dir).select("id", F.md5(T.clean(F.col("x"))).alias("cleaned_md5")))


@query
def q_norm_name(spark, sf_dir):
    named = _names(spark, sf_dir).select("id", T.name(F.col("x")).alias("canonical"))
    return named.select("id", "canonical", T.root(F.col("canonical")).alias("root"))


@query
def q_norm_addr(spark, sf_dir):
    return _addresses(spark, sf_dir).select("id", T.address(F.col("x")).alias("norm_addr"))


@query
def q_norm_country(spark, sf_dir):
    return _countries(spark, sf_dir).select("id", T.country(F.col("x")).alias("norm_country"))


@query
def q_block_norm_name(spark, sf_dir):
    return _names(spark, sf_dir).select("id", T.block_name(F.col("x")).alias("block_name"))


@query
def q_block_norm_addr(spark, sf_dir):
    return _addresses(spark, sf_dir).select("id", T.block_address(F.col("x")).alias("block_addr"))


@query
def q_numeric_tokens(spark, sf_dir):
    return _addresses(spark, sf_dir).select("id", F.array_join(T.numbers(F.col("x")), "|").alias("numbers"))


@query
def q_char_ngrams(spark, sf_dir):
    cleaned = _names(spark, sf_dir).select("id", T.clean(F.col("x")).alias("x"))
    return cleaned.select("id", F.array_join(F.sort_array(T.ngrams(F.col("x"))), "|").alias("grams"))


@query
def q_word_tokens(spark, sf_dir):
    cleaned = _names(spark, sf_dir).select("id", T.clean(F.col("x")).alias("x"))
    return cleaned.select("id", F.array_join(F.sort_array(T.words(F.col("x"))), "|").alias("words"))


@query
def q_tokens(spark, sf_dir):
    return blocking.block_tokens(E.entities(spark, sf_dir))


@query
def q_token_freq(spark, sf_dir):
    return blocking.token_frequency(blocking.block_tokens(E.entities(spark, sf_dir)))


@query
def q_token_purge(spark, sf_dir):
    return blocking.purge(blocking.block_tokens(E.entities(spark, sf_dir)), 25)


@query
def q_block_name(spark, sf_dir):
    return blocking.candidates(E.entities(spark, sf_dir), 25, ("name",))


@query
def q_block_addr(spark, sf_dir):
    return blocking.candidates(E.entities(spark, sf_dir), 25, ("address",))


@query
def q_block_all(spark, sf_dir):
    return blocking.candidates(E.entities(spark, sf_dir), 25)


@query
def q_block_grouped(spark, sf_dir):
    ents = E.entities(spark, sf_dir)
    return blocking.grouped(E.s1(ents), blocking.candidates(ents, 25))


@query
def q_block_country(spark, sf_dir):
    ents = E.entities(spark, sf_dir)
    return blocking.country_stats(E.s1(ents), blocking.candidates(ents, 25))


@query
def q_block_first_token(spark, sf_dir):
    ents = E.entities(spark, sf_dir)
    return blocking.first_token(E.s1(ents), E.targets(ents))


@query
def q_block_recall(spark, sf_dir):
    ents = E.entities(spark, sf_dir)
    return blocking.recall(E.truth(ents), blocking.candidates(ents, 5))


def _pairs(spark, sf_dir):
    """Business names of the fixture against parts and among blocking candidates."""
    ents = E.entities(spark, sf_dir)
    pairs = blocking.candidates(ents, 25)
    a = ents.select(F.col("entity_id").alias("s1_id"), F.col("business_name").alias("x"), F.col("business_address").alias("xa"))
    b = ents.select(F.col("entity_id").alias("cand_id"), F.col("business_name").alias("y"), F.col("business_address").alias("ya"))
    return pairs.join(a, "s1_id").join(b, "cand_id")


@query
def q_sim_edit(spark, sf_dir):
    return _pairs(spark, sf_dir).select("s1_id", "cand_id", S.edit(F.col("x"), F.col("y")).alias("sim"))


@query
def q_sim_token_sort(spark, sf_dir):
    return _pairs(spark, sf_dir).select("s1_id", "cand_id", S.token_sort(F.col("x"), F.col("y")).alias("sim"))


@query
def q_sim_token_set(spark, sf_dir):
    return _pairs(spark, sf_dir).select("s1_id", "cand_id", S.token_set(F.col("x"), F.col("y")).alias("sim"))


@query
def q_sim_jaccard_word(spark, sf_dir):
    return _pairs(spark, sf_dir).select("s1_id", "cand_id", S.jaccard(T.words(F.col("x")), T.words(F.col("y"))).alias("sim"))


@query
def q_sim_jaccard_3gram(spark, sf_dir):
    return _pairs(spark, sf_dir).select("s1_id", "cand_id", S.jaccard(T.ngrams(F.col("x")), T.ngrams(F.col("y"))).alias("sim"))


def _features(spark, sf_dir, names):
    ents = E.entities(spark, sf_dir)
    out = features.pair_features(blocking.candidates(ents, 25), E.s1(ents), E.targets(ents), names)
    b = E.business(spark)
    ids = F.col("entity_id")
    left, right = b.filter(F.startswith(ids, F.lit("S1-"))), b.filter(~F.startswith(ids, F.lit("S1-")))
    # the fixture's few rows, each S1 row with the targets of its own number and an unknown id
    own = left.select(ids.alias("s1_id"), F.explode(F.array(*(F.lit(t) for t in ("S2-1", "S3-1", "S2-2", "S2-3", "S3-3", "S2-5", "S2-6", "S3-6", "S2-999")))).alias("cand_id"))
    return out.unionByName(features.pair_features(own, left, right, names))


@query
def q_feat_name(spark, sf_dir):
    return _features(spark, sf_dir, features.NAMES[:8])


@query
def q_feat_addr(spark, sf_dir):
    return _features(spark, sf_dir, features.NAMES[8:14])


@query
def q_feat_numeric(spark, sf_dir):
    return _features(spark, sf_dir, features.NAMES[14:17])


@query
def q_feat_country_missing(spark, sf_dir):
    return _features(spark, sf_dir, features.NAMES[17:])


@query
def q_features_all(spark, sf_dir):
    return _features(spark, sf_dir, features.NAMES)


@query
def q_label_pairs(spark, sf_dir):
    ents = E.entities(spark, sf_dir)
    return training.label(blocking.candidates(ents, 25), E.truth(ents))


@query
def q_positives(spark, sf_dir):
    ents = E.entities(spark, sf_dir)
    return training.positives(E.truth(ents), E.s1(ents), E.targets(ents), 1000)


@query
def q_negatives(spark, sf_dir):
    ents = E.entities(spark, sf_dir)
    return training.hard_negatives(E.s1(ents), E.targets(ents), E.truth(ents), 500)


@query
def q_split(spark, sf_dir):
    ents = E.entities(spark, sf_dir)
    return training.split(blocking.candidates(ents, 25))


@query
def q_class_weights(spark, sf_dir):
    ents = E.entities(spark, sf_dir)
    return training.class_weights(training.label(blocking.candidates(ents, 25), E.truth(ents)))


def _labelled(spark, sf_dir):
    ents = E.entities(spark, sf_dir)
    return training.label(E.scored(ents), E.truth(ents))


@query
def q_confusion(spark, sf_dir):
    return metrics.confusion(_labelled(spark, sf_dir), THRESHOLD)


@query
def q_pair_metrics(spark, sf_dir):
    return metrics.rates(metrics.confusion(_labelled(spark, sf_dir), THRESHOLD))


@query
def q_threshold_sweep(spark, sf_dir):
    return metrics.sweep(_labelled(spark, sf_dir))


@query
def q_best_threshold(spark, sf_dir):
    return metrics.best(metrics.sweep(_labelled(spark, sf_dir)))


@query
def q_entity_metrics(spark, sf_dir):
    ents = E.entities(spark, sf_dir)
    predicted = results.matches(E.scored(ents), THRESHOLD).select("s1_id", F.col("cand_id").alias("target_id"))
    return metrics.entity_metrics(E.truth(ents), predicted)


@query
def q_results(spark, sf_dir):
    ents = E.entities(spark, sf_dir)
    return results.assemble(E.s1(ents), results.matches(E.scored(ents), THRESHOLD))


@query
def q_results_at_best(spark, sf_dir):
    """What prediction does with scores: a threshold chosen on labelled pairs, then one row for each entity of source 1."""
    ents = E.entities(spark, sf_dir)
    scored = E.scored(ents)
    best = metrics.best(metrics.sweep(training.label(scored, E.truth(ents)))).first()
    cut = models.threshold(None, {"selected_threshold": best.threshold}, None)
    return results.assemble(E.s1(ents), results.matches(scored, cut))


@query
def q_results_summary(spark, sf_dir):
    return results.summary(q_results(spark, sf_dir))


@query
def q_validate(spark, sf_dir):
    ents = E.entities(spark, sf_dir)
    pairs = kept(blocking.candidates(ents, 25), "pairs")
    candidates = results.check_candidates(blocking.grouped(E.s1(ents), pairs), E.truth(ents))
    table = kept(results.assemble(E.s1(ents), results.matches(E.scored(ents, pairs), THRESHOLD)), "results")
    found = results.check_results(table, E.s1(ents), pairs)
    return candidates.withColumn("checked", F.lit("candidates")).unionByName(found.withColumn("checked", F.lit("results")))


def _training(spark, sf_dir):
    """Labelled feature rows with the grouped split."""
    ents = E.entities(spark, sf_dir)
    pairs = training.training_pairs(E.truth(ents), E.s1(ents), E.targets(ents), 2000)
    f = features.pair_features(pairs, E.s1(ents), E.targets(ents))
    return training.split(pairs.join(f, ["s1_id", "cand_id"])), ents


def _fitted(spark, sf_dir, kind, trees, depth):
    rows, ents = _training(spark, sf_dir)
    rows = kept(rows, "rows")
    model = models.fit(rows.filter("not validation"), kind, trees, depth)
    return model, models.score(model, rows.filter("validation")), ents


@query
def q_model_rf(spark, sf_dir):
    return _fitted(spark, sf_dir, "random_forest", 20, 8)[1].select("s1_id", "cand_id", "label", "prob")


@query
def q_model_gbt(spark, sf_dir):
    return _fitted(spark, sf_dir, "lightgbm", 10, 4)[1].select("s1_id", "cand_id", "label", "prob")


@query
def q_model_importance(spark, sf_dir):
    return models.importances(_fitted(spark, sf_dir, "random_forest", 20, 8)[0], spark)


@query
def q_predict_end_to_end(spark, sf_dir):
    """Train, choose a threshold on the validation entities, save, load, score all candidates, assemble results."""
    model, validated, ents = _fitted(spark, sf_dir, "random_forest", 20, 8)
    best = metrics.best(metrics.sweep(validated)).first()
    path = f"{scratch.root(spark)}/model-{uuid.uuid4().hex}"
    scratch.delete_at_end(spark, path)
    models.save(model, path, best.threshold, "random_forest")
    model, side = models.load(path)
    pairs = blocking.candidates(ents, 25)
    scored = models.score(model, features.pair_features(pairs, E.s1(ents), E.targets(ents)))
    return results.assemble(E.s1(ents), results.matches(scored, models.threshold(None, None, side)))
