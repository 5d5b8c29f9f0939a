"""No size, sign or spelling drops rows or changes the rule."""

import math
import random

import pytest
from pyspark.sql import functions as F

from textloom.functions import markup
from textloom.functions.text import is_numeric
from textloom.operators import bayes, embed, generate, lemma, metrics, ordering, profile
from textloom.sources import files, pages


@pytest.mark.parametrize("k", [1, 7, 50, 9_999, 10_001])
def test_top_k_of_signed_scores(spark, k):
    values = [float(v) for v in range(-24, 26)] + [None, 0.0, -0.0, float("inf"), float("-inf"), 1e-300, -1e-300, float("nan")]
    df = spark.createDataFrame(list(enumerate(values)), "id long, score double")
    rank = lambda r: (r[1] is None, 0 if r[1] is None else -math.inf if math.isnan(r[1]) else 0, 0 if r[1] is None or math.isnan(r[1]) else -r[1], r[0])
    expected = [i for i, _ in sorted(enumerate(values), key=rank)][:k]
    assert [r.id for r in ordering.top_k(df, "score", "id", k).collect()] == expected


def test_draws_reach_every_part(spark):
    size = 10**10
    draws = [r[0] for r in spark.range(2000).select(generate.draw(F.lit(size), F.lit(42), F.col("id"))).collect()]
    assert all(0 <= d < size for d in draws) and len(set(draws)) > 1990
    # 32 bits could not tell neighbours apart here.
    assert len({d % 8 for d in draws}) == 8 and sum(d > size / 2 for d in draws) in range(900, 1100)


def test_lemmas_to_the_end(spark):
    words = spark.createDataFrame([("catssss",), ("bossesses",), ("dogs",), ("xyz",)], "token string")
    known = spark.createDataFrame([("cat",), ("boss",), ("dog",)], "word string")
    got = {r.token: r.lemma for r in lemma.lemma_table(words, known).collect()}
    assert got == {"catssss": "cat", "bossesses": "boss", "dogs": "dog", "xyz": "xyz"}


@pytest.mark.parametrize("seed", range(3))
def test_lemmas_like_round_by_round(spark, seed):
    rng = random.Random(seed)
    parts = ["s", "ses", "ves", "xes", "ches", "shes", "men", "ies", "a", "cat", "e", "z"]
    words = {"".join(rng.choices(parts, k=rng.randint(1, 6))) for _ in range(300)} | {"s" * 3000, "q" + "es" * 40}
    known = {w[: rng.randint(1, len(w))] for w in rng.sample(sorted(w for w in words if len(w) < 100), 80)} | {"man", "f"}
    special = {w: rng.sample(sorted(known), 2) for w in rng.sample(sorted(words), 10)}

    def shorter(w):
        return [w[: len(w) - len(end)] + new for end, new in lemma.NOUN_ENDINGS if w.endswith(end)]

    def plainly(w):
        if w in special:
            found = [c for c in special[w] if c in known]
            return w if w in known and all(len(c) >= len(w) for c in found) else min(found, key=lambda c: (len(c), c))
        forms = shorter(w)
        candidates = [w, *forms]
        while candidates:
            found = [c for c in candidates if c in known]
            if found:
                return min(found, key=lambda c: (len(c), candidates.index(c)))
            candidates = forms = [f for c in forms for f in shorter(c)]
        return w

    table = spark.createDataFrame([(w, len(w)) for w in words] + [(None, 0)], "token string, n int")
    dictionary = spark.createDataFrame([(w,) for w in known] * 2, "word string")
    exceptions = spark.createDataFrame([(w, c) for w, cs in special.items() for c in cs], "word string, lemma string")
    rows = lemma.lemma_table(table, dictionary, exceptions, ["n"]).collect()
    assert len(rows) == len(words) + 1 and all(r.n == len(r.token or "") for r in rows)
    assert {r.token: r.lemma for r in rows if r.token is not None} == {w: plainly(w) for w in words}
    empty = dictionary.filter("false")
    assert {r.token: r.lemma for r in lemma.lemma_table(table, empty).collect()} == {w: w for w in [*words, None]}


def test_many_classes(spark):
    df = spark.range(12_000).select(F.col("id").cast("string").alias("label"), ((F.col("id") + 1) % 12_000).cast("string").alias("prediction"))
    assert metrics.class_report(df).count() == 12_003
    few = spark.createDataFrame([("a", "b"), ("b", "b"), ("c", "a")], "label string, prediction string")
    assert {(r.label, r.prediction): r.n for r in metrics.confusion_matrix(few).collect()} == {
        (x, y): int((x, y) in {("a", "b"), ("b", "b"), ("c", "a")}) for x in "abc" for y in "abc"
    }


def test_sparse_scores_are_complete(spark):
    docs = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id long, label string")
    counts = spark.createDataFrame([(1, "p", 2), (1, "q", 1), (2, "q", 3), (3, "r", 1)], "id long, term string, tf long")
    model = bayes.fit_multinomial(docs, counts, "id")
    got = {(r.id, r.label): r.score for r in bayes.scores(model, spark.createDataFrame([(9, "x"), (8, "x")], "id long, label string"),
           spark.createDataFrame([(9, "q", 2), (9, "unknown", 5)], "id long, term string, tf long"), "id").collect()}
    seen = {"x": {"p": 2, "q": 1}, "y": {"q": 3}, "z": {"r": 1}}
    for label, terms in seen.items():
        total = sum(terms.values()) + 3
        assert got[(8, label)] == pytest.approx(math.log(1 / 3))
        assert got[(9, label)] == pytest.approx(math.log(1 / 3) + 2 * math.log((terms.get("q", 0) + 1) / total))


def test_search_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embed, "QUERY_BLOCK", 3)
    docs = spark.createDataFrame([(i, [math.cos(i), math.sin(i)]) for i in range(40)], "id long, vector array<double>")
    queries = docs.select(F.col("id").alias("query_id"), "vector").limit(20)
    got = embed.search(docs, queries, 1, "id").collect()
    assert len(got) == 20 and all(r.query_id == r.id for r in got)


def test_means_of_all_numeric_columns(spark):
    df = spark.createDataFrame([(1,), (2,)], "i int").selectExpr("i", "cast(i as decimal(9,2)) d", "cast(i as tinyint) b", "cast(i as string) s")
    assert profile.rounded_means(df).columns == ["i", "d", "b"]


def test_numeric_characters(spark):
    texts = ["五", "12", "½", "Ⅷ", "a1", "", "三千", "٣", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).select(is_numeric("t")).collect()]
    assert got == [bool(t and t.isnumeric()) for t in texts]


def test_page_attributes(spark):
    tag = """<a Href='x?a="1"' class = c1 title="it's" data-x=1 empty="" href="second">"""
    row = spark.createDataFrame([(tag,)], "t string").select(markup.page_attributes("t")).first()
    assert row[0] == {"href": "second", "class": "c1", "title": "it's", "data-x": "1", "empty": ""}


def test_chart_page_with_any_quotes(spark):
    html = (
        "<div class='o-chart-results-list-row-container x'><h3>One</h3><span class='c-label'>1</span><span class='a c-label b'>Ann</span></div>"
        "<div id=r class=o-chart-results-list-row-container><h3>Two</h3><span class=c-label>Bob</span></div>"
        '<div class="o-chart-results-list-row-container"><h3>Three</h3><span class="c-label">3</span><span class="c-label">Cid</span></div>'
    )
    got = pages.chart_rows(spark.createDataFrame([(2020, html)], "year int, html string")).collect()
    assert [(r.pos, r.title, r.artist) for r in got] == [(0, "One", "Ann"), (1, "Two", "Bob"), (2, "Three", "Cid")]


def test_links_without_address_are_dropped(spark):
    rows = [("http://h.example/", "<a name=x>Plain Text</a>"), ("http://h.example/", "<a href='b.txt'>the Plain Text</a>")]
    got = pages.first_link(spark.createDataFrame(rows, "url string, html string"), "Plain Text").collect()
    assert [r.link for r in got] == ["http://h.example/b.txt"]


@pytest.mark.parametrize("multi_line", [True, False])
def test_csv_columns_by_name(spark, tmp_path, multi_line):
    (tmp_path / "a.csv").write_text('artist,title\nABBA,"Waterloo, live"\nnan,X\n')
    got = files.read_csv(spark, str(tmp_path), "title string, artist string", multi_line=multi_line).collect()
    assert [(r.title, r.artist) for r in got] == [("Waterloo, live", "ABBA"), ("X", None)]
    (tmp_path / "b.csv").write_text("title,artist\nOther,Order\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(tmp_path), "title string, artist string", multi_line=multi_line).collect()


def test_other_clusters_are_not_local(monkeypatch):
    from textloom import session

    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="shared folder"):
        session.ensure_checkpoint_dir(Session())
