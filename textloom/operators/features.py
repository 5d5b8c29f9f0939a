"""Term counts, vocabularies and TF-IDF weights in long form (``id``, ``term``, value)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.text import bind, long_words, once
from textloom.operators.ordering import top_k
from textloom.operators.skew import lookup_join, lookup_table, small_join
from textloom.session import cut_lineage

# Vocabularies up to this size are broadcast: their size is bounded by the parameter.
LARGEST_BROADCAST = 100_000
# A capped vocabulary is first narrowed by the sums of so many hash buckets; the number changes the work, never the terms.
BUCKETS = 1 << 22


def word_ngrams(tokens: Column, low: int, high: int) -> Column:
    """All runs of ``low`` to ``high`` tokens, joined by blanks."""
    parts = []
    for n in range(low, high + 1):
        if n == 1:
            parts.append(tokens)
            continue
        size = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
        shifted = F.arrays_zip(*[F.slice(tokens, F.lit(k + 1), size).alias(f"t{k}") for k in range(n)])
        parts.append(F.transform(shifted, _joiner(n)))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def _joiner(n: int) -> Callable[[Column], Column]:
    return lambda run: F.concat_ws(" ", *[run[f"t{k}"] for k in range(n)])


def counted(terms: Column) -> Column:
    """The different values of an array with their numbers, as structs (``term``, ``tf``): run lengths of the sorted array."""

    def runs(ordered: Column) -> Column:
        begins = lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))
        starts = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), begins)
        end = lambda found, j: F.coalesce(F.get(found, j + 1), F.size(ordered))
        entry = lambda found: lambda i, j: F.struct(F.get(ordered, i).alias("term"), (end(found, j) - i).cast("bigint").alias("tf"))
        return F.when(F.size(ordered) > 0, bind(starts, lambda found: F.transform(found, entry(found))))

    return bind(F.sort_array(F.filter(terms, lambda x: x.isNotNull())), runs)


def term_counts(df: DataFrame, id_column: str, terms: Column | None = None, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Rows (id, ``term``, ``tf``) and the columns ``keep``; by default terms are lower-case words of two or more characters.

    A document is one row, so its terms are counted within the row and nothing is shuffled.
    """
    terms = long_words(text) if terms is None else terms
    return df.select(id_column, *keep, F.inline(counted(terms)))


def binary_terms(counts: DataFrame) -> DataFrame:
    """Term presence: any positive count becomes 1."""
    return counts.withColumn("tf", (F.col("tf") > 0).cast("bigint"))


def learn_vocabulary(train_counts: DataFrame, max_features: int | None = None) -> DataFrame:
    """Rows (``term``, ``total``, ``df``): occurrences and documents, the most frequent terms only if capped.

    Counts are not negative. With a cap, terms are summed up by hash bucket first, at most ``BUCKETS`` rows a task however many terms
    there are. A term has at most its bucket's sum, so only the terms of heavy buckets are counted as such, and
    they hold the most frequent ones once enough of them reach the limit below which buckets were left out; else the limit is lowered.
    """
    if max_features is None:
        return _totals(train_counts)
    hashed = train_counts.withColumn("_bucket", F.pmod(F.xxhash64("term"), F.lit(BUCKETS)))
    sums = cut_lineage(hashed.groupBy("_bucket").agg(F.sum("tf").alias("_sum")))
    # Sums hold other terms too, so twice as many buckets as wanted terms are taken to begin with.
    heaviest = sums.orderBy(F.desc("_sum")).limit(2 * max_features).agg(F.count(F.lit(1)), F.min("_sum")).first()
    limit = heaviest[1] if heaviest[0] == 2 * max_features else 0
    while limit is not None and limit > 1:
        heavy = sums.filter(F.col("_sum") >= limit).select("_bucket")
        found = cut_lineage(_totals(small_join(hashed, heavy, ["_bucket"], ["term"], stored=True)).filter(F.col("total") >= limit))
        if found.count() >= max_features:
            return cut_lineage(found.orderBy(F.desc("total"), "term").limit(max_features))
        limit = limit // 2
    return cut_lineage(top_k(cut_lineage(_totals(train_counts)), "total", "term", max_features))


def _totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df"))


def restrict(counts: DataFrame, vocabulary: DataFrame, id_column: str, bound: int | None = None) -> DataFrame:
    """Counts of known terms, with their document frequency.

    ``bound`` is the size a capped vocabulary cannot exceed; only then is it broadcast.
    """
    known = vocabulary.select("term", "df")
    if bound is not None and bound <= LARGEST_BROADCAST:
        return counts.join(F.broadcast(known), "term")
    return lookup_join(counts, known, ["term"], None, [id_column])


def tfidf(
    counts: DataFrame, vocabulary: DataFrame, n_documents: DataFrame, id_column: str, bound: int | None = None
) -> DataFrame:
    """Rows (id, ``term``, ``weight``): tf * (ln((1 + n) / (1 + df)) + 1), each document scaled to length 1.

    ``n_documents`` is one row with the number of training documents; vocabulary and document
    frequencies come from training documents too.
    """
    n = n_documents.scalar().cast("double")
    idf = F.log((n + 1) / (F.col("df") + 1)) + 1
    raw = restrict(counts, vocabulary, id_column, bound).withColumn("_raw", F.col("tf") * idf)
    length = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy(id_column)))
    return raw.select(id_column, "term", (F.col("_raw") / length).alias("weight"))


def tfidf_rows(
    df: DataFrame, id_column: str, terms: Column, vocabulary: DataFrame, n_documents: DataFrame, bound: int, keep: Sequence[str] = ()
) -> DataFrame:
    """As ``tfidf`` for a vocabulary of at most ``bound`` terms, worked out within each row of ``df``; the columns ``keep`` stay.

    Terms are counted, looked up, weighted and scaled inside the row, so nothing is shuffled by term or by document.
    """
    known = lookup_table(vocabulary, "term", ["df"], bound)

    def weight(c: Column) -> Column:
        idf = lambda e: F.log((F.col("_n") + 1) / (e["df"] + 1)) + 1
        return bind(known.get(c["term"]), lambda e: F.struct(c["term"].alias("term"), (c["tf"] * idf(e)).alias("weight")))

    def scaled(rows: Column) -> Column:
        length = F.sqrt(F.aggregate(rows, F.lit(0.0), lambda total, r: total + r["weight"] * r["weight"]))
        return bind(length, lambda size: F.transform(rows, lambda r: F.struct(r["term"].alias("term"), (r["weight"] / size).alias("weight"))))

    raw = F.filter(F.transform(counted(terms), weight), lambda r: r["weight"].isNotNull())
    inputs = known.attach(df).withColumn("_n", n_documents.scalar().cast("double"))
    # Projected first, so that the table is shared, then held by `once`, so that no inferred filter works the rows out again.
    rows = once(inputs.select(id_column, *keep, bind(raw, scaled).alias("_rows")), "_kept", F.col("_rows"))
    return rows.select(id_column, *keep, F.inline("_kept"))
