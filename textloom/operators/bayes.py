"""Naive Bayes as aggregations: sparse parameters, dense results.

A class gives every term it never saw the same value, so a model is two small-to-sparse
tables: ``classes`` (``label``, ``base``, ``unseen``) and ``terms`` with one row per term,
``extra`` mapping each class that saw the term to what it adds to ``unseen``.
The score of a document is ``base + sum(tf * (unseen + extra))`` over its known terms.
Priors are not smoothed.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.text import bind
from textloom.operators.ordering import top_per_group
from textloom.operators.skew import packed_rows, small_join
from textloom.session import cut_lineage


# Classes whose names and constants travel inside an expression, some hundred bytes each; more fail with a message.
MOST_CLASSES = 100_000


class BayesModel(NamedTuple):
    classes: DataFrame
    terms: DataFrame


def _class_sizes(docs: DataFrame) -> DataFrame:
    sizes = docs.groupBy("label").agg(F.count(F.lit(1)).alias("n_docs"))
    return sizes.withColumn("prior", F.log(F.col("n_docs") / sizes.agg(F.sum("n_docs")).scalar()))


def _class_term_counts(docs: DataFrame, counts: DataFrame, id_column: str, value: str) -> DataFrame:
    """Rows (``label``, ``term``, ``s``, ``d``): summed values and documents. Counts that carry their ``label`` need no join."""
    labelled = counts if "label" in counts.columns else counts.join(docs.select(id_column, "label"), id_column)
    return labelled.groupBy("label", "term").agg(F.sum(value).alias("s"), F.count_if(F.col(value) > 0).alias("d"))


def _terms(seen: DataFrame, extra: Column) -> DataFrame:
    entry = F.struct("label", extra.alias("extra"))
    return seen.groupBy("term").agg(
        F.sum("d").alias("df"), F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("extra")
    )


def _stored(classes: DataFrame, terms: DataFrame, seen: DataFrame) -> BayesModel:
    """Write the model's two tables, so that scoring does not fit again."""
    model = BayesModel(cut_lineage(classes), cut_lineage(terms))
    seen.unpersist()
    return model


def fit_multinomial(docs: DataFrame, counts: DataFrame, id_column: str, value: str = "tf", alpha: float = 1.0) -> BayesModel:
    """Fit on ``docs`` (id, ``label``) and ``counts`` (id, ``term``, value); values may be fractions."""
    seen = _class_term_counts(docs, counts, id_column, value).persist()
    v = seen.agg(F.count_distinct("term")).scalar()
    totals = seen.groupBy("label").agg(F.sum("s").alias("total"))
    sizes = _class_sizes(docs).join(totals, "label", "left").withColumn("total", F.coalesce("total", F.lit(0)))
    classes = sizes.select("label", F.col("prior").alias("base"), F.log(alpha / (F.col("total") + alpha * v)).alias("unseen"))
    return _stored(classes, _terms(seen, F.log((F.col("s") + alpha) / alpha)), seen)


def fit_bernoulli(docs: DataFrame, counts: DataFrame, id_column: str, value: str = "tf", alpha: float = 1.0) -> BayesModel:
    """Fit on term presence. The penalty for absent terms is part of ``base``, so scoring stays sparse."""
    seen = _class_term_counts(docs, counts, id_column, value).persist()
    v = seen.agg(F.count_distinct("term")).scalar()
    sizes = _class_sizes(docs)
    room = F.col("n_docs") + 2 * alpha
    absent = F.log((F.col("n_docs") - F.col("d") + alpha) / (F.col("n_docs") + alpha))
    with_sizes = _with_class_columns(seen, sizes)
    penalties = with_sizes.groupBy("label").agg(F.sum(absent).alias("penalty"))
    unseen_absent = F.log((F.col("n_docs") + alpha) / room)
    classes = sizes.join(penalties, "label", "left").select(
        "label",
        (F.col("prior") + v * unseen_absent + F.coalesce("penalty", F.lit(0.0))).alias("base"),
        (F.log(F.lit(alpha)) - F.log(F.col("n_docs") + alpha)).alias("unseen"),
    )
    present = F.log((F.col("d") + alpha) / (F.col("n_docs") - F.col("d") + alpha))
    extra = present - (F.log(F.lit(alpha)) - F.log(F.col("n_docs") + alpha))
    return _stored(classes, _terms(with_sizes, extra), seen)


def _with_class_columns(seen: DataFrame, sizes: DataFrame) -> DataFrame:
    """Attach class sizes without a join: the few classes travel as one map."""
    entries = packed_rows(sizes.select("label", "n_docs"), ["label", "n_docs"], MOST_CLASSES)
    return seen.withColumn("_sizes", F.map_from_entries(entries)).withColumn("n_docs", F.col("_sizes")[F.col("label")]).drop("_sizes")


def parameters(model: BayesModel) -> DataFrame:
    """Rows (``label``, ``term``, ``value``) for the terms each class saw: the class's value of the term."""
    seen = model.terms.select("term", F.explode("extra").alias("label", "_extra"))
    classes = packed_rows(model.classes.select("label", "unseen"), ["label", "unseen"], MOST_CLASSES)
    unseen = F.map_from_entries(classes)[F.col("label")]
    return seen.select("label", "term", (unseen + F.col("_extra")).alias("value"))


def scores(model: BayesModel, docs: DataFrame, counts: DataFrame, id_column: str, value: str = "tf") -> DataFrame:
    """Rows (id, ``label``, ``score``) for every document and class, documents without known terms too.

    A known term gives one row for each class that saw it, and one for its weight, not one per class: what the
    other classes give it is ``unseen`` times the weight, which is summed up once per document. The counts are read once: a stored
    model that fits is sent to them, so that a document's terms are added up in the task that counted them.
    """
    known = small_join(counts.select(id_column, "term", value), model.terms, ["term"], [id_column], stored=True, weight="df")
    entries = F.transform(F.map_entries("extra"), lambda e: F.struct(e["key"].alias("label"), (F.col(value) * e["value"]).alias("part")))
    # The weight goes under no label.
    weight = F.transform(F.slice(entries, 1, 1), lambda e: F.struct(F.nullif(e["label"], e["label"]).alias("label"), F.col(value).cast("double").alias("part")))
    sums = known.select(id_column, F.inline(F.concat(entries, weight))).groupBy(id_column, "label").agg(F.sum("part").alias("part"))
    seen = sums.groupBy(id_column).agg(
        F.map_from_entries(F.collect_list(F.when(F.col("label").isNotNull(), F.struct("label", "part")))).alias("_seen"),
        F.sum(F.when(F.col("label").isNull(), F.col("part"))).alias("_weight"),
    )
    classes = packed_rows(model.classes, ["label", "base", "unseen"], MOST_CLASSES)
    grid = docs.select(id_column).join(seen, id_column, "left").select("*", F.inline(classes))
    weight = F.coalesce("_weight", F.lit(0.0)) * F.col("unseen")
    part = F.coalesce(F.col("_seen")[F.col("label")], F.lit(0.0))
    return grid.select(id_column, "label", (F.col("base") + weight + part).alias("score"))


def predict(scored: DataFrame, id_column: str) -> DataFrame:
    """Rows (id, ``prediction``): the class with the highest score, ties by label."""
    order = [F.desc(F.round("score", 9)), "label"]
    best = top_per_group(scored, [id_column], order, 1, "_place")
    return best.select(id_column, F.col("label").alias("prediction"))


def probabilities(scored: DataFrame, id_column: str) -> DataFrame:
    """Rows (id, ``label``, ``probability``)."""
    per_document = Window.partitionBy(id_column)
    shifted = F.exp(F.col("score") - F.max("score").over(per_document))
    weights = scored.select(id_column, "label", shifted.alias("_weight"))
    return weights.select(id_column, "label", (F.col("_weight") / F.sum("_weight").over(per_document)).alias("probability"))


def topic_predictions(
    train: DataFrame,
    test: DataFrame,
    train_counts: DataFrame,
    test_counts: DataFrame,
    topics: DataFrame,
    id_column: str,
) -> DataFrame:
    """One-against-rest predictions for all ``topics`` by both models, fitted in one pass.

    ``train`` and ``test`` are (id, ``topics`` array); ``topics`` is a short table (``topic``). Training counts that carry their
    ``topics`` need no join.
    Result rows: (id, ``topic``, ``actual``, ``mnb``, ``bnb``).

    Class 1 is counted per topic and term; class 0 is what is left of the term's total. The
    two scores only matter by their difference, which for a term that never met a topic
    depends on the term's totals alone, so no topic-by-term grid is shuffled.
    """
    wanted = train.withColumn("_wanted", packed_rows(topics, ["topic"]))
    listed = wanted.select(id_column, F.array_intersect("topics", F.col("_wanted.topic")).alias("_topics"))
    # Every count goes under its topics and under no topic, so totals and topics come from one pass; the training counts are read once.
    if "topics" in train_counts.columns:
        counted = train_counts.withColumn("_wanted", packed_rows(topics, ["topic"]))
        counted = counted.select("term", "tf", F.array_intersect("topics", F.col("_wanted.topic")).alias("_topics"))
    else:
        counted = train_counts.join(listed, id_column)
    no_topic = F.array(F.lit(None).cast(topics.schema["topic"].dataType))
    places = F.concat(no_topic, F.filter(F.coalesce("_topics", F.array()), lambda x: x.isNotNull()))
    # Documents with the same topics are added up before a count goes under each of them, so the counts themselves are not multiplied.
    alike = counted.groupBy("term", "_topics").agg(F.sum("tf").alias("s"), F.count(F.lit(1)).alias("d")).repartition("term")
    met_by = alike.select("term", "s", "d", F.explode(places).alias("topic")).groupBy("term", "topic").agg(F.sum("s").alias("s"), F.sum("d").alias("d"))
    entry = F.when(F.col("topic").isNotNull(), F.struct("topic", F.struct(F.col("s").alias("s1"), F.col("d").alias("d1")).alias("c")))
    total = [F.max(F.when(F.col("topic").isNull(), F.col(c))).alias(c) for c in ("s", "d")]
    terms = cut_lineage(met_by.groupBy("term").agg(*total, F.map_from_entries(F.collect_list(entry)).alias("seen")))

    n_train = train.agg(F.count(F.lit(1))).scalar()
    sizes = listed.select(F.explode("_topics").alias("topic")).groupBy("topic").agg(F.count(F.lit(1)).alias("n1"))
    ones = terms.select(F.explode("seen").alias("topic", "c")).groupBy("topic").agg(F.sum("c.s1").alias("t1"))
    overall = terms.agg(F.sum("s").alias("t"), F.count(F.lit(1)).alias("v"))
    n1 = F.coalesce("n1", F.lit(0))
    facts = topics.join(sizes, "topic", "left").join(ones, "topic", "left").select(
        "topic",
        n1.alias("n1"),
        (n_train - n1).alias("n0"),
        F.coalesce("t1", F.lit(0)).alias("t1"),
        overall.select("t").scalar().alias("t"),
        overall.select("v").scalar().alias("v"),
    )
    facts = cut_lineage(facts)
    packed = packed_rows(facts, ["topic", "n1", "n0", "t1", "t", "v"])

    def with_met(t: Column, use: Callable[[Column, Column], Column]) -> Column:
        """``use`` of the term's summed values and documents in a topic, looked up once."""
        zero = F.lit(0).cast("bigint")
        return bind(F.col("seen")[t["topic"]], lambda c: use(F.coalesce(c["s1"], zero), F.coalesce(c["d1"], zero)))

    def absent(t: Column) -> Column:
        one = lambda d1: (t["n1"] - d1 + 1) / (t["n1"] + 2)
        rest = lambda d1: (t["n0"] - (F.col("d") - d1) + 1) / (t["n0"] + 2)
        return with_met(t, lambda s1, d1: F.log(one(d1)) - F.log(rest(d1)))

    penalties = terms.withColumn("_facts", packed).select(
        F.inline(F.transform("_facts", lambda t: F.struct(t["topic"].alias("topic"), absent(t).alias("absent"))))
    ).groupBy("topic").agg(F.sum("absent").alias("absent"))
    # A topic that no or every training row has leaves one class to predict.
    one_sided = F.when(F.col("n1") == 0, F.lit(float("-inf"))).when(F.col("n0") == 0, F.lit(float("inf")))
    prior = one_sided.otherwise(F.log(F.col("n1") / F.col("n0")))
    bases = packed_rows(
        facts.join(penalties, "topic", "left").select(
            "topic", prior.alias("mnb"), (prior + F.coalesce("absent", F.lit(0.0))).alias("bnb")
        ),
        ["topic", "mnb", "bnb"],
    )

    def term_parts(t: Column) -> Column:
        def parts(s1: Column, d1: Column) -> Column:
            d0 = F.col("d") - d1
            total1, total0 = t["t1"] + t["v"], t["t"] - t["t1"] + t["v"]
            mnb = F.log((s1 + 1) / total1) - F.log((F.col("s") - s1 + 1) / total0)
            bnb = F.log((d1 + 1) / (t["n1"] - d1 + 1)) - F.log((d0 + 1) / (t["n0"] - d0 + 1))
            return F.struct(t["topic"].alias("topic"), (F.col("tf") * mnb).alias("mnb"), bnb.alias("bnb"))

        return with_met(t, parts)

    weighed = terms.withColumn("_weight", F.col("d"))
    known = small_join(test_counts.select(id_column, "term", "tf"), weighed, ["term"], [id_column], stored=True, weight="_weight")
    parts = known.withColumn("_facts", packed).select(id_column, F.inline(F.transform("_facts", term_parts)))
    starts = test.select(id_column, F.inline(bases))
    sums = starts.unionByName(parts).groupBy(id_column, "topic").agg(F.sum("mnb").alias("mnb"), F.sum("bnb").alias("bnb"))
    return sums.join(test.select(id_column, "topics"), id_column).select(
        id_column,
        "topic",
        F.array_contains("topics", F.col("topic")).cast("bigint").alias("actual"),
        (F.round("mnb", 9) > 0).cast("bigint").alias("mnb"),
        (F.round("bnb", 9) > 0).cast("bigint").alias("bnb"),
    )
