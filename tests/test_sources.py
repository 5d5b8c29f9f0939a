"""Reading and writing files, and the composite jobs on small inputs."""

import pytest
from pyspark.sql import functions as F

from textloom.plans import jobs
from textloom.sources import files, news, pages

STOP = ["the", "a", "and", "of", "is"]


def record(number, topics="YES", split="TRAIN", names=("x",), body="text"):
    listed = "".join(f"<D>{n}</D>" for n in names)
    text = f"<TEXT><BODY>{body}\n&#3;</BODY></TEXT>" if body is not None else "<TEXT></TEXT>"
    return f'<REUTERS TOPICS="{topics}" LEWISSPLIT="{split}" NEWID="{number}">\n<TOPICS>{listed}</TOPICS>{text}\n</REUTERS>\n'


@pytest.fixture(scope="module")
def news_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("news")
    one = "<!DOCTYPE x>\n" + record(1, names=("grain", "wheat"), body="Café &lt;b&gt; grain wheat crop") + record(2, topics="NO")
    one += record(3, split="TEST", names=(), body="nothing here") + record(4, body=None) + record(5, split="NOT-USED")
    two = "".join(record(10 + i, split="TRAIN" if i % 3 else "TEST", names=("grain",) if i % 2 else ("oil",), body="grain crop field" if i % 2 else "oil price barrel") for i in range(30))
    (folder / "a.sgm").write_bytes(one.encode("latin-1"))
    (folder / "b.sgm").write_bytes(two.encode("latin-1"))
    (folder / "c.txt").write_bytes(record(99).encode())
    return str(folder)


def test_labelled_records(spark, news_folder):
    rows = news.read_labelled(spark, news_folder).orderBy("filename", "record_ix").collect()
    first = [(r["record_ix"], r["lewissplit"], r["topics"], r["body_text"]) for r in rows if r["filename"] == "a.sgm"]
    assert first == [(1, "TRAIN", "grain,wheat", "Café <b> grain wheat crop"), (2, "TEST", "", "nothing here"), (3, "TRAIN", "x", None)]
    assert [r["record_ix"] for r in rows if r["filename"] == "b.sgm"] == list(range(1, 31))


def test_split_files_give_the_same_records(spark, news_folder):
    whole = sorted(map(tuple, news.read_labelled(spark, news_folder).collect()), key=str)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        cut = news.read_labelled(spark, news_folder)
        assert cut.rdd.getNumPartitions() >= 1
        assert sorted(map(tuple, cut.collect()), key=str) == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_articles(spark, news_folder):
    rows = {r["id"]: r for r in news.read_articles(spark, news_folder).collect()}
    assert len(rows) == 35 and rows["4"]["text"] == "" and rows["1"]["topics"] == ["grain", "wheat"]
    assert rows["1"]["text"] == "Café <b> grain wheat crop\n\x03"


def test_topic_and_corpus_jobs(spark, news_folder):
    records = news.read_labelled(spark, news_folder).withColumn("id", F.concat_ws(":", "filename", "record_ix"))
    result = jobs.topic_nb_job(records, 2)
    scores = {r["topic"]: r for r in result["scores"].collect()}
    assert scores["oil"]["mnb_f1"] == 1.0 and set(scores) == {"oil", "grain"}
    assert [r["model"] for r in result["comparison"].collect()] == ["Multinomial NB", "Bernoulli NB"]
    described = jobs.corpus_description_job(records, STOP)
    assert described["shape"].collect()[0]["n_rows"] == 33
    assert {r["term"] for r in described["vocabulary"].collect()} >= {"grain", "crop", "oil"}
    assert described["term_counts"].filter("term = 'wheat'").count() == 0
    assert described["top_topics"].collect()[0]["topic"] in ("oil", "grain")


def test_search_job(spark, news_folder):
    articles = news.read_articles(spark, news_folder)
    queries = spark.createDataFrame([(1, "Oil PRICE!"), (2, "grain crop")], "query_id bigint, text string")
    results = jobs.semantic_search_job(articles, queries, STOP, 3, 8)["results"].collect()
    assert len(results) == 6 and all("oil" in r["preview"] for r in results if r["query_id"] == 1)


def test_csv_and_texts(spark, tmp_path):
    csv = tmp_path / "x.csv"
    csv.write_text('title,tag,artist,year,lyrics,language\n"A ""q"", b",pop,None,2004,"l1\nl2",en\nNA,misc,x,bad,y,en\n')
    rows = files.read_csv(spark, str(csv), files.LYRICS, ["title", "artist", "year", "lyrics"]).collect()
    assert [tuple(r) for r in rows] == [('A "q", b', None, "2004", "l1\nl2"), (None, "x", "bad", "y")]
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "b1.TXT").write_text("one\ntwo\n")
    (tmp_path / "t" / "b2.txt").write_text("three")
    (tmp_path / "t" / "b3.md").write_text("no")
    texts = files.read_texts(spark, str(tmp_path / "t"))
    assert {r["doc_id"]: r["text"] for r in texts.collect()} == {"b1": "one\ntwo\n", "b2": "three"}
    files.write_text_files(texts, str(tmp_path / "out"))
    back = spark.read.text(str(tmp_path / "out"), wholetext=True)
    assert {r["doc_id"]: r["value"] for r in back.collect()} == {"b1": "one\ntwo\n\n", "b2": "three\n"}


def test_text_files_are_written_by_all_tasks(spark, tmp_path):
    """A table of one partition is dealt out; ids are escaped, an id's rows share a file, missing texts are empty lines."""
    rows = [(str(i), f"text {i}") for i in range(200)] + [("a/b=c:%", "odd"), ("7", "again"), (None, "no id"), ("", None), ("x", None)]
    table = spark.createDataFrame(rows, "doc_id string, text string").coalesce(1)
    files.write_text_files(table, f"file:{tmp_path / 'new'}")
    found = {p.parent.name: p.read_text() for p in (tmp_path / "new").rglob("*.txt")}
    table.withColumnRenamed("text", "value").write.partitionBy("doc_id").text(str(tmp_path / "old"))
    assert found == {p.parent.name: p.read_text() for p in (tmp_path / "old").rglob("*.txt")}
    assert len(found) == 203 and found["doc_id=7"] == "text 7\nagain\n"
    assert all(p.name == "part-0.txt" for p in (tmp_path / "new").rglob("*") if p.is_file())
    with pytest.raises(FileExistsError):
        files.write_text_files(table, str(tmp_path / "new"))


def test_catalogue_links(spark):
    html = '<h2 id="other">x</h2><ol><li><a href="/no">n</a></li></ol><h2 id="books-last30">T</h2><p></p><ol><li><a href="/e/1">1</a> <a href="/z">z</a></li><li>none</li><li><a href="e/2">2</a></li></ol><ol><li><a href="/3">3</a></li></ol>'
    df = spark.createDataFrame([("http://h.example/top/", html)], "url string, html string")
    assert [(r["pos"], r["link"]) for r in jobs.catalogue_links(df).collect()] == [(0, "http://h.example/e/1"), (1, "http://h.example/top/e/2")]


def chart_page(rows):
    body = "".join(
        f'<div class="a {pages.CHART_ROW}"><h3> {title} </h3><span class="c-label">1</span><span class="c-label"> {artist}\n x </span></div>'
        for title, artist in rows
    )
    return f"<html>{body}</html>"


def test_chart_and_lyrics_jobs(spark):
    charts = [(2004, chart_page([("Hey (Live)", "Bo Featuring Al"), ("Hey (Live)", "Bo Featuring Al"), ("", "No"), ("Sun!", "Ann &amp; Co")])), (2005, chart_page([(f"T{i}", "Z") for i in range(120)]))]
    ranked = jobs.chart_job(spark.createDataFrame(charts, "year int, html string"))
    assert ranked.filter("year = 2005").count() == 100
    first = [(r["title"], r["rank"], r["top_10"]) for r in ranked.filter("year = 2004").orderBy("rank").collect()]
    assert first == [("Hey (Live)", 1, 1), ("Sun!", 2, 1)]
    checks = {r["check"] for r in jobs.chart_quality_job(ranked).collect()}
    assert {"n_null", "rank", "year", "head", "name"} <= checks
    lyrics = spark.createDataFrame(
        [
            ("HEY", "pop", "Bo", "2004", "la", "en"), ("Sun", None, "Ann", "2010", "lo", "en"), ("Sun", "misc", "Ann", "2010", "lo", "en"),
            ("Hey", "pop", "Bo", "1999", "la", "en"), ("Hey", "pop", "Bo", "bad", "la", "en"), ("Hey", "pop", "Bo", "2004", "la", "fr"),
        ],
        "title string, tag string, artist string, year string, lyrics string, language string",
    )
    result = jobs.lyrics_match_job(lyrics, ranked)
    assert [r["n"] for r in result["funnel"].orderBy("step").collect()] == [6, 5, 3, 2, 2]
    assert sorted(r["title"] for r in result["matched"].collect()) == ["HEY", "Sun"]
    summary = result["summary"].collect()[0]
    assert (summary["n_rows"], summary["n_matched"], summary["n_matched_distinct"]) == (2, 2, 2)


def test_author_and_genre_jobs(spark):
    words = {"ann": "sun sea sand beach", "bob": "code bug test build", "cy": "rare"}
    rows = [(i, name, f"{words[name].split()[i % 4]} {words[name].split()[(i + 1) % 4]} #x {i}") for i in range(40) for name in ("ann", "bob")]
    rows.append((99, "cy", "rare"))
    posts = spark.createDataFrame([(n, u, x) for n, (_, u, x) in enumerate(rows)], "id bigint, username string, text string")
    result = jobs.author_classifier_job(posts, 2, 200, examples=["sun and sand", "a bug"])
    assert result["Naive Bayes: accuracy"].collect()[0]["accuracy"] == 1.0
    assert {(r["text"], r["predicted"]) for r in result["examples"].collect()} == {("sun and sand", "ann"), ("a bug", "bob")}
    songs = posts.select("id", F.col("text").alias("lyrics"), F.col("username").alias("tag")).filter("tag <> 'cy'")
    dictionary = spark.createDataFrame([("sun",), ("bug",)], "word string")
    genres = jobs.genre_classifier_job(songs, STOP, dictionary, max_features=50, max_iter=10)
    assert genres["LinearSVC: macro F1"].collect()[0]["macro_f1"] > 0.9
    top = {r["term"] for r in genres["top words"].filter("label = 'ann'").collect()}
    assert top <= {"sun", "sea", "sand", "beach", "sun sea", "sea sand", "sand beach", "beach sun"}


def test_book_and_language_jobs(spark):
    text = "{0}\nA Title\n\nContents\none\n\nThe cats sat. The cat ran and the cats ran.\n{1}\nlicense"
    raw = spark.createDataFrame([("1", text.format("*** START OF THE PROJECT GUTENBERG EBOOK T ***", "*** END OF THE PROJECT GUTENBERG EBOOK T ***"))], "doc_id string, text string")
    dictionary = spark.createDataFrame([("cat",)], "word string")
    result = jobs.book_preprocess_job(raw, dictionary, vocab_size=30)
    assert "license" not in result["cleaned"].collect()[0]["text"] and "one" not in result["cleaned"].collect()[0]["text"]
    assert {r["lemma"]: r["n"] for r in result["lemmas"].collect()}["cat"] == 3
    assert result["totals"].collect()[0]["vocabulary_size"] == result["vocabulary"].count()
    contexts = spark.createDataFrame([("the",)], "context string")
    starts = spark.createDataFrame([(1, "the")], "walk bigint, context string")
    models = jobs.language_model_job(jobs.clean_books(raw), contexts, starts, 5)
    assert models["predictions"].orderBy("place").collect()[0]["next"] == "cats"
    assert models["sentences"].collect()[0]["sentence"].startswith("the cat")
    assert {r["model"] for r in models["comparison"].collect()} == {"bigram", "trigram"}
