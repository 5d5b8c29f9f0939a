"""Tokens, cleaners and keys."""

from __future__ import annotations

import string

from pyspark.sql import functions as F

from textloom.functions import books, cleaners, keys
from textloom.functions import text as t
from textloom.operators import dictionary, frequency, lemma
from textloom.session import cut_lineage
from workload.registry import query, table

# Fixed values shared by the Spark jobs and the SQL texts.
SPACE = t.SPACE
STOP = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its "
    "itself they them their theirs themselves what which who whom this that these those am is are was were be been being "
    "have has had having do does did doing a an the and but if or because as until while of at by for with about against "
    "between into through during before after above below to from up down in out on off over under again further then once "
    "here there when where why how all any both each few more most other some such no nor not only own same so than too very "
    "s t can will just don should now"
).split()
EMOJI = {"🔥": ":fire:", "❤️": ":red_heart:", "😀": ":grinning_face:"}
WORDS = r"[\p{L}\p{N}_]+"


def sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def sql_in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


PUNCTUATION = string.punctuation.replace("'", "''")
TOKENS = f"SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORDS}')) AS token FROM documents"


@query("word_tokens", f"WITH toks AS ({TOKENS}) SELECT doc_id, count(*) AS n_tokens, count(DISTINCT token) AS n_distinct, sum(length(token))::BIGINT AS n_letters FROM toks GROUP BY doc_id")
def word_tokens(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("tokens", t.words(F.lower("text")))
    return docs.filter(F.size("tokens") > 0).select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.size(F.array_distinct("tokens")).cast("bigint").alias("n_distinct"),
        F.length(F.concat_ws("", "tokens")).cast("bigint").alias("n_letters"),
    )


@query("word_freq", f"WITH toks AS ({TOKENS}) SELECT token, count(*) AS n FROM toks GROUP BY token")
def word_freq(spark, sf_dir):
    return frequency.word_counts(table(spark, sf_dir, "documents"), t.words(F.lower("text")))


@query("word_freq_top20", f"WITH toks AS ({TOKENS}) SELECT token, count(*) AS n FROM toks GROUP BY token ORDER BY n DESC, token LIMIT 20")
def word_freq_top20(spark, sf_dir):
    tokens = table(spark, sf_dir, "documents").select(F.explode(t.words(F.lower("text"))).alias("token"))
    return frequency.top_values(tokens, "token", 20)


# Sentences: pieces between runs of . ! ? with at least one word; each one ends with the end mark.
SENTENCES = f"""
pieces AS (
  SELECT doc_id, unnest(string_split_regex(lower(text), '[.!?]+')) AS sentence,
         generate_subscripts(string_split_regex(lower(text), '[.!?]+'), 1) AS s FROM documents),
worded AS (SELECT doc_id, s, regexp_extract_all(sentence, '{WORDS}') AS ws FROM pieces),
closed AS (SELECT doc_id, s, list_append(ws, '<EOS>') AS ws FROM worded WHERE len(ws) > 0),
toks AS (SELECT doc_id, s, unnest(ws) AS tok, generate_subscripts(ws, 1) AS p FROM closed)"""


@query(
    "sentence_tokens",
    f"""WITH {SENTENCES} SELECT doc_id, string_agg(tok, ' ' ORDER BY s, p) AS tokens, count(*) AS n_tokens,
    count(DISTINCT s) AS n_sentences FROM toks GROUP BY doc_id""",
)
def sentence_tokens(spark, sf_dir):
    tokens = table(spark, sf_dir, "documents").select("doc_id", t.sentence_tokens("text").alias("toks"))
    return tokens.filter(F.size("toks") > 0).select(
        "doc_id",
        F.array_join("toks", " ").alias("tokens"),
        F.size("toks").cast("bigint").alias("n_tokens"),
        F.size(F.filter("toks", lambda w: w == t.EOS)).cast("bigint").alias("n_sentences"),
    )


POST = "text || CASE doc_id % 3 WHEN 0 THEN ' #tag https://x.example/a?b=1 @user 🔥!' WHEN 1 THEN ' ❤️ 😀' ELSE '' END"
URL = "http[s]?://[a-zA-Z0-9$-_@.&+!*(),]+"


def _named(sql: str) -> str:
    for mark, name in EMOJI.items():
        sql = f"replace({sql}, '{mark}', '{name}')"
    return sql


POST_SQL = f"regexp_replace({POST}, '#[^{SPACE}]+', '', 'g')"
POST_SQL = f"regexp_replace(regexp_replace({POST_SQL}, '{URL}', ' ', 'g'), '@[^{SPACE}]+', '', 'g')"
POST_SQL = f"lower({_named(f'''translate({POST_SQL}, '{PUNCTUATION}', '')''')})"


@query("post_clean", f"SELECT doc_id, {POST_SQL} AS cleaned FROM documents WHERE text IS NOT NULL")
def post_clean(spark, sf_dir):
    posts = table(spark, sf_dir, "documents").select("doc_id", F.expr(POST).alias("post")).dropna(subset=["post"])
    return posts.select("doc_id", cleaners.clean_post("post", EMOJI).alias("cleaned"))


LYRIC = "CASE WHEN turn % 2 = 0 THEN '[Chorus] ❤️ ' ELSE '' END || text"
LYRIC_SQL = f"""lower({_named(f"regexp_replace({LYRIC}, '\\[[^\\n]*?\\]', '', 'g')")})"""
LYRIC_SQL = f"regexp_extract_all(translate({LYRIC_SQL}, '{PUNCTUATION}', ''), '[^{SPACE}]+')"


@query(
    "lyric_clean",
    f"""SELECT conv_id, turn, array_to_string([w FOR w IN {LYRIC_SQL} IF w NOT IN {sql_in(STOP)}], ' ') AS cleaned
    FROM conversations WHERE text IS NOT NULL AND role IS NOT NULL""",
)
def lyric_clean(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").dropna(subset=["text", "role"])
    lyrics = turns.withColumn("lyrics", F.expr(LYRIC))
    return lyrics.select("conv_id", "turn", F.array_join(cleaners.lyric_tokens("lyrics", STOP, EMOJI), " ").alias("cleaned"))


def _treebank(sql: str) -> str:
    """Tokens of a lower-case SQL text: whitespace pieces, six words cut in two, quotation marks apart."""
    sql = f"regexp_replace({sql}, '([«“‘„»”’])', ' \\1 ', 'g')"
    pieces = f"regexp_extract_all({sql}, '[^{SPACE}]+')"
    cut = "CASE w " + " ".join(
        f"WHEN '{p.replace('|', '')}' THEN ['{p.split('|')[0]}', '{p.split('|')[1]}']" for p in t.SPLIT_WORDS
    )
    return f"flatten([{cut} ELSE [w] END FOR w IN {pieces}])"


NEWS = "CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN text || ' I cannot don''t 1234 ½ x' ELSE text END"
NEWS_SQL = f"""array_to_string([w FOR w IN {_treebank(f"lower(translate({NEWS}, '{PUNCTUATION}', ''))")}
IF w NOT IN {sql_in(STOP)} AND length(w) > 1 AND NOT regexp_matches(w, '^[{t.DIGIT}]+$')], ' ')"""


@query("news_tokens", f"SELECT doc_id, coalesce({NEWS_SQL}, '') AS tokens FROM documents")
def news_tokens(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.expr(NEWS).alias("body"))
    return docs.select("doc_id", F.array_join(cleaners.news_tokens("body", STOP), " ").alias("tokens"))


SEARCH_SQL = f"[w FOR w IN {_treebank(f'''regexp_replace(lower(text), '[^a-z{SPACE}]', '', 'g')''')} IF w NOT IN {sql_in(STOP)}]"


@query("search_tokens", f"SELECT doc_id, array_to_string({SEARCH_SQL}, ' ') AS tokens FROM documents")
def search_tokens(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.array_join(cleaners.search_tokens("text", STOP), " ").alias("tokens"))


STOPPED = f"[w FOR w IN regexp_extract_all(lower(text), '{WORDS}') IF w NOT IN {sql_in(STOP)}]"


@query(
    "rare_term_cut",
    f"""WITH toks AS (SELECT doc_id, source, {STOPPED} AS ws FROM documents),
    long AS (SELECT doc_id, source, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM toks),
    vocab AS (SELECT w FROM long WHERE source <> 'src1' GROUP BY w HAVING count(*) > 1),
    kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS kept FROM long WHERE w IN (SELECT w FROM vocab) GROUP BY doc_id)
    SELECT d.doc_id, coalesce(k.kept, '') AS kept FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id""",
)
def rare_term_cut(spark, sf_dir):
    words = t.drop_words(t.words(F.lower("text")), STOP)
    corpus = dictionary.encode_corpus(table(spark, sf_dir, "documents"), "doc_id", words, F.col("source") != "src1")
    return corpus.known(2).select("doc_id", F.array_join("tokens", " ").alias("kept"))


BOOK = (
    "'Header line' || chr(13) || chr(10) || CASE WHEN doc_id % 5 = 4 THEN '' ELSE '*** START OF THE PROJECT GUTENBERG EBOOK A BOOK ***' END "
    "|| chr(13) || chr(10) || CASE doc_id % 4 WHEN 0 THEN 'Table of CONTENTS' || chr(10) || 'one' || chr(10) || 'two' || chr(10) || '  ' || chr(10) "
    "WHEN 1 THEN 'Contents' || chr(13) || chr(13) || chr(10) || 'one' || chr(10) "
    "WHEN 2 THEN 'contents' || chr(10) || 'one' || chr(10) || repeat('long ', 21) || chr(10) ELSE '' END || text "
    "|| chr(10) || chr(9) || CASE WHEN doc_id % 7 = 0 THEN '' ELSE '*** END OF THE PROJECT GUTENBERG EBOOK A BOOK ***' || chr(10) || 'License' END"
)
LINE_END = r"\r\n|[\n-\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"
BOOK_SQL = f"""WITH wrapped AS (SELECT doc_id, {BOOK} AS book FROM documents),
begun AS (SELECT doc_id, CASE WHEN instr(book, '{books.START_MARKER}') > 0
  THEN regexp_replace(substr(book, instr(book, '{books.START_MARKER}') + {len(books.START_MARKER)}), '[{SPACE}]+$', '') ELSE book END AS b FROM wrapped),
split AS (SELECT doc_id, string_split_regex(b, '{LINE_END}') AS ls FROM begun),
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS p, len(ls) AS size FROM split),
cut AS (SELECT * FROM lines WHERE NOT (p = size AND line = '')),
heads AS (SELECT doc_id, min(p) AS h FROM cut WHERE contains(lower(line), 'contents') GROUP BY doc_id),
ends AS (SELECT c.doc_id, min(p) AS e FROM cut c JOIN heads USING (doc_id) WHERE p > h
  AND length(regexp_replace(regexp_replace(line, '^[{SPACE}]+', ''), '[{SPACE}]+$', '')) NOT BETWEEN 1 AND 100 GROUP BY c.doc_id),
kept AS (SELECT c.doc_id, p, line FROM cut c LEFT JOIN heads h USING (doc_id) LEFT JOIN ends e USING (doc_id)
  WHERE h.h IS NULL OR h.h = 1 OR p < h.h OR p > coalesce(e.e, h.h)),
bodies AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY p) AS body FROM kept GROUP BY doc_id)
SELECT doc_id, CASE WHEN instr(body, '{books.END_MARKER}') > 0
  THEN regexp_replace(substr(body, 1, instr(body, '{books.END_MARKER}') - 1), '[{SPACE}]+$', '') ELSE body END AS body FROM bodies"""


@query("book_clean", BOOK_SQL)
def book_clean(spark, sf_dir):
    wrapped = table(spark, sf_dir, "documents").select("doc_id", F.expr(BOOK).alias("book"))
    return wrapped.select("doc_id", books.clean_book("book").alias("body"))


TITLE = "p_name || CASE p_partkey % 5 WHEN 0 THEN ' (Live) [2003]' WHEN 1 THEN '!  ' WHEN 2 THEN '''s É_x' WHEN 3 THEN ' (a' || chr(10) || 'b) ' ELSE '' END"
TITLE_SQL = rf"regexp_replace(regexp_replace({TITLE}, '\([^\n]*?\)', '', 'g'), '[^\p{{L}}\p{{N}}_{SPACE}]', '', 'g')"
TITLE_SQL = f"lower(regexp_replace(regexp_replace({TITLE_SQL}, '^[{SPACE}]+', ''), '[{SPACE}]+$', ''))"


@query("title_key", f"SELECT p_partkey, {TITLE_SQL} AS title_clean FROM part")
def title_key(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.expr(TITLE).alias("title"))
    return parts.select("p_partkey", keys.title_key("title").alias("title_clean"))


ARTIST = (
    "CASE c_custkey % 8 WHEN 0 THEN c_name || ' Featuring Z' WHEN 1 THEN 'Maxwell ' || c_name WHEN 2 THEN c_name || ' & Co' "
    "WHEN 3 THEN 'Duo With ' || c_name WHEN 4 THEN 'Afeaturing B' WHEN 5 THEN c_name || ', Other' WHEN 6 THEN 'A X B' ELSE '  ' || c_name END"
)
ARTIST_SQL = rf"regexp_extract(regexp_replace({ARTIST}, '(?i)([a-z])(featuring)', '\1 \2', 'g'), '(?is)^(.*?)(?:\bfeaturing\b|\bwith\b|&|,|x[a-z]|$)', 1)"
ARTIST_SQL = f"lower(regexp_replace(regexp_replace({ARTIST_SQL}, '^[{SPACE}]+', ''), '[{SPACE}]+$', ''))"


@query("artist_key", f"SELECT c_custkey, {ARTIST_SQL} AS artist_clean FROM customer")
def artist_key(spark, sf_dir):
    names = table(spark, sf_dir, "customer").select("c_custkey", F.expr(ARTIST).alias("artist"))
    return names.select("c_custkey", keys.artist_key("artist").alias("artist_clean"))


WORD_COUNTS = f"wc AS (SELECT token, count(*) AS n FROM ({TOKENS}) GROUP BY token)"


def _stem_sql() -> str:
    """Porter steps as a chain of subqueries over the distinct words."""
    from textloom.functions import stems as st

    shape = r"regexp_replace(regexp_replace(regexp_replace(w, '([^aeiou])y', '\1Y', 'g'), '[aeiouY]', 'V', 'g'), '[^V]', 'C', 'g')"
    steps = [f"{WORD_COUNTS}, s0 AS (SELECT token, n, token AS w FROM wc)"]

    def step(body: str) -> None:
        i = len(steps)
        steps.append(f"s{i} AS (SELECT token, n, {body} AS w FROM (SELECT token, n, w, {shape} AS f, length(w) AS k FROM s{i - 1}))")

    def rules(pairs, condition) -> str:
        parts = [
            f"WHEN ends_with(w, '{end}') THEN CASE WHEN {condition(end)} THEN left(w, k - {len(end)}) || '{new}' ELSE w END"
            for end, new in pairs
        ]
        return "CASE " + " ".join(parts)

    def matches(end, pattern) -> str:
        return f"regexp_matches(left(f, k - {len(end)}), '{pattern}')"

    one = "^C*V+C+V*$"
    step("CASE WHEN ends_with(w, 'ies') AND k = 4 THEN left(w, 3) " + rules(st.PLURALS, lambda e: "true")[5:] + " ELSE w END")
    # The marker @ says that -ed or -ing went and the stem may need mending.
    step(
        "CASE WHEN ends_with(w, 'ied') THEN left(w, CASE WHEN k = 4 THEN 3 ELSE k - 2 END) "
        f"WHEN ends_with(w, 'eed') THEN CASE WHEN {matches('eed', '^C*V+C')} THEN left(w, k - 1) ELSE w END "
        "WHEN ends_with(w, 'ed') THEN CASE WHEN contains(left(f, k - 2), 'V') THEN left(w, k - 2) || '@' ELSE w END "
        "WHEN ends_with(w, 'ing') THEN CASE WHEN contains(left(f, k - 3), 'V') THEN left(w, k - 3) || '@' ELSE w END ELSE w END"
    )
    short = "((regexp_matches(g, 'CVC$') AND NOT regexp_matches(v, '[wxy]$')) OR g = 'VC')"
    steps.append(
        f"m AS (SELECT token, n, w, rtrim(w, '@') AS v, left({shape}, length(rtrim(w, '@'))) AS g FROM s2),"
        "s3 AS (SELECT token, n, CASE WHEN v = w THEN w WHEN regexp_matches(v, '(at|bl|iz)$') THEN v || 'e' "
        "WHEN length(v) > 1 AND v[-1] = v[-2] AND regexp_matches(g, 'C$') THEN CASE WHEN v[-1] IN ('l', 's', 'z') THEN v ELSE left(v, length(v) - 1) END "
        f"WHEN regexp_matches(g, '{one}') AND {short} THEN v || 'e' ELSE v END AS w FROM m)"
    )
    step("CASE WHEN ends_with(w, 'y') AND regexp_matches(left(f, k - 1), '.C$') THEN left(w, k - 1) || 'i' ELSE w END")
    step(f"CASE WHEN ends_with(w, 'alli') AND {matches('alli', '^C*V+C')} THEN left(w, k - 2) ELSE w END")
    step(
        rules(st.STEP_2, lambda e: matches(e, "^C*V+C"))
        + f" WHEN ends_with(w, 'logi') THEN CASE WHEN {matches('ogi', '^C*V+C')} THEN left(w, k - 1) ELSE w END ELSE w END"
    )
    step(rules(st.STEP_3, lambda e: matches(e, "^C*V+C")) + " ELSE w END")
    step(
        rules(
            [(e, "") for e in st.STEP_4],
            lambda e: matches(e, "^C*V+C+V+C") + (" AND regexp_matches(w, '[st]ion$')" if e == "ion" else ""),
        )
        + " ELSE w END"
    )
    step(
        f"CASE WHEN ends_with(w, 'e') AND ({matches('e', '^C*V+C+V+C')} OR ({matches('e', one)} AND NOT "
        "((regexp_matches(left(f, k - 1), 'CVC$') AND NOT regexp_matches(left(w, k - 1), '[wxy]$')) OR left(f, k - 1) = 'VC'))) "
        "THEN left(w, k - 1) ELSE w END"
    )
    step(f"CASE WHEN ends_with(w, 'll') AND {matches('l', '^C*V+C+V+C')} THEN left(w, k - 1) ELSE w END")
    irregular = "CASE token " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in st.IRREGULAR.items())
    last = len(steps) - 1
    steps.append(f"stems AS (SELECT n, {irregular} ELSE CASE WHEN length(token) <= 2 THEN token ELSE w END END AS stem FROM s{last})")
    return "WITH " + ",\n".join(steps)


STEMS = _stem_sql()
STEM_COUNTS = "sc AS (SELECT stem, sum(n)::BIGINT AS n FROM stems GROUP BY stem)"


def _word_counts(spark, sf_dir):
    return frequency.word_counts(table(spark, sf_dir, "documents"), t.words(F.lower("text")))


@query("stem_freq", f"{STEMS}, {STEM_COUNTS} SELECT stem, n FROM sc")
def stem_freq(spark, sf_dir):
    return lemma.stem_counts(_word_counts(spark, sf_dir))


@query("stem_top20", f"{STEMS}, {STEM_COUNTS} SELECT stem, n, (SELECT count(*) FROM sc) AS n_distinct FROM sc ORDER BY n DESC, stem LIMIT 20")
def stem_top20(spark, sf_dir):
    return lemma.top_with_size(lemma.stem_counts(_word_counts(spark, sf_dir)), "stem")


# The dictionary: words seen five times or more. Candidates: the word, then its shorter forms, up to three rounds.
def _forms(source: str, column: str) -> str:
    return " UNION ALL ".join(
        f"SELECT token, pos * 10 + {i} AS pos, left({column}, length({column}) - {len(end)}) || '{new}' AS c FROM {source} WHERE ends_with({column}, '{end}')"
        for i, (end, new) in enumerate(lemma.NOUN_ENDINGS)
    )


LEMMAS = f"""{WORD_COUNTS}, dict AS (SELECT token AS word FROM wc WHERE n >= 5),
itself AS (SELECT token, 0::BIGINT AS pos, token AS c FROM wc),
r1 AS ({_forms('itself', 'c')}), r2 AS ({_forms('r1', 'c')}), r3 AS ({_forms('r2', 'c')}),
cand AS (SELECT token, 0 AS r, -1 AS pos, c FROM itself UNION ALL SELECT token, 0, pos, c FROM r1
  UNION ALL SELECT token, 1, pos, c FROM r2 UNION ALL SELECT token, 2, pos, c FROM r3),
best AS (SELECT token, c, row_number() OVER (PARTITION BY token ORDER BY r, length(c), pos) AS place
  FROM cand WHERE c IN (SELECT word FROM dict)),
lc AS (SELECT coalesce(b.c, wc.token) AS lemma, sum(n)::BIGINT AS n FROM wc LEFT JOIN best b ON b.token = wc.token AND b.place = 1 GROUP BY 1)"""


def _lemma_counts(spark, sf_dir):
    counts = cut_lineage(_word_counts(spark, sf_dir))
    return lemma.lemma_counts(counts, counts.filter("n >= 5").select(F.col("token").alias("word")))


@query("lemma_freq", f"WITH {LEMMAS} SELECT lemma, n FROM lc")
def lemma_freq(spark, sf_dir):
    return _lemma_counts(spark, sf_dir)


@query("lemma_top20", f"WITH {LEMMAS} SELECT lemma, n, (SELECT count(*) FROM lc) AS n_distinct FROM lc ORDER BY n DESC, lemma LIMIT 20")
def lemma_top20(spark, sf_dir):
    return lemma.top_with_size(_lemma_counts(spark, sf_dir), "lemma")


@query(
    "lemma_stem_diff",
    f"""{STEMS}, {STEM_COUNTS}, {LEMMAS[len(WORD_COUNTS) + 2:]}, sizes AS (SELECT (SELECT count(*) FROM lc) AS n_lemmas, (SELECT count(*) FROM sc) AS n_stems)
    SELECT n_lemmas, n_stems, abs(n_stems - n_lemmas) AS difference,
    CASE WHEN n_stems > n_lemmas THEN 'stems' WHEN n_stems < n_lemmas THEN 'lemmas' ELSE 'equal' END AS more FROM sizes""",
)
def lemma_stem_diff(spark, sf_dir):
    return lemma.compare_sizes(_lemma_counts(spark, sf_dir), lemma.stem_counts(_word_counts(spark, sf_dir)))


@query(
    "lyric_lemmas",
    f"""WITH lines AS (SELECT conv_id * 1000 + turn AS id, [w FOR w IN {LYRIC_SQL} IF w NOT IN {sql_in(STOP)}] AS ws FROM conversations),
    long AS (SELECT id, unnest(ws) AS token, generate_subscripts(ws, 1) AS p FROM lines),
    wc AS (SELECT token, count(*) AS n FROM long GROUP BY token), {LEMMAS[len(WORD_COUNTS) + 2 : LEMMAS.index('lc AS')].rstrip().rstrip(',')},
    done AS (SELECT id, string_agg(coalesce(b.c, long.token), ' ' ORDER BY p) AS lemmas FROM long LEFT JOIN best b ON b.token = long.token AND b.place = 1 GROUP BY id)
    SELECT l.id, coalesce(d.lemmas, '') AS lemmas FROM lines l LEFT JOIN done d ON l.id = d.id""",
)
def lyric_lemmas(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.expr(LYRIC).alias("lyrics"))
    lines = turns.select("id", cleaners.lyric_tokens("lyrics", STOP, EMOJI).alias("ws"))
    counts = cut_lineage(frequency.word_counts(lines, F.col("ws")))
    dictionary = counts.filter("n >= 5").select(F.col("token").alias("word"))
    lemmas = lemma.lemma_table(counts, dictionary, keep=["n"]).withColumnRenamed("lemma", "replacement")
    replaced = lemma.replace_tokens(lines.select("id", "ws"), "id", F.col("ws"), lemmas)
    return replaced.select("id", F.array_join("tokens", " ").alias("lemmas"))
