import random
from collections import defaultdict

import pytest

import corpus_pipeline
from brute import Groups, deduplicated, shingle_fingerprint
from test_decontaminate import words
from test_quality import expected, prose
from textloom.llm import queries


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(11)
    folder = str(tmp_path_factory.mktemp("tables"))
    items = [(i, prose(rng, "en", 25)) for i in range(6)]
    rows = [(i, "\n".join(prose(rng, "en", rng.randrange(20, 60)) for _ in range(4)), "en") for i in range(90)]
    for i in range(20):
        rows.append((200 + i, rows[i][1] + (" extra" if i % 2 else ""), "en"))
        rows.append((300 + i, f"{prose(rng, 'en', 40)}\n{rows[50][1]}\n{prose(rng, 'en', 60)}", "en"))
        rows.append((400 + i, f"{prose(rng, 'en', 80)} {items[i % 6][1]} {prose(rng, 'en', 30)}", "en"))
    rows += [(500, "### *** " * 100, "en"), (501, None, "en"), (502, "", None), (0, rows[0][1], "en")]
    table = [(d, t, lang, f"src{(d or 0) % 3}", len(t or "")) for d, t, lang in rows]
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_like_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near duplicates", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        docs = stage(spark, docs, tables).cache()
        after = [tuple(r) for r in docs.collect()]
        if name != "packing":
            assert docs.columns == columns
        texts = [(r[0], r[1], r[2]) for r in before]
        if name == "quality rules":
            assert sorted(r[0] for r in after) == sorted(r[0] for r in expected(texts) if r[-1])
            assert set(after) <= set(before)
        elif name == "line dedup":
            wanted = deduplicated([(d, t) for d, t, _ in texts])
            assert sorted(r[0] for r in after) == sorted(r[0] for r in before)
            assert {r[0]: r[1] for r in after} == wanted and all(r[4] == len(r[1]) for r in after)
        elif name == "near duplicates":
            marks = [shingle_fingerprint(t) for _, t, _ in texts]
            groups = Groups(range(len(texts)))
            for i in range(len(texts)):
                for j in range(i):
                    if (marks[i] ^ marks[j]).bit_count() <= 4:
                        groups.join(i, j)
            least = defaultdict(list)
            for i, (doc, _, _) in enumerate(texts):
                least[groups.root(i)].append(doc)
            assert sorted(r[0] for r in after) == sorted(min(g) for g in least.values())
            assert set(after) <= set(before)
        elif name == "decontamination":
            grams = {tuple(w[i : i + 10]) for w in (words(t) for _, t in items) for i in range(len(w) - 9)}
            clean = [r for r in before if not grams & {tuple(words(r[1])[i : i + 10]) for i in range(len(words(r[1])) - 9)}]
            assert sorted(after, key=str) == sorted(clean, key=str) and len(clean) < len(before)
        else:
            assert {r[0] for r in after} == {r[0] for r in before}


def test_run_is_registered(spark, tables):
    rows = corpus_pipeline.run(spark, tables).collect()
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(rows[0].asDict())
    assert corpus_pipeline.ORACLE_SQL is None


def test_every_operator_has_a_query():
    assert [q.split("_")[0] for q in sorted(queries.QUERIES, key=lambda q: int(q.split("_")[0][2:]))] == [f"op{i}" for i in range(1, 14)]
