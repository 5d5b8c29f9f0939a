"""Column functions against plain Python definitions."""

import html
import random
import re
import string
from urllib.parse import urljoin

from pyspark.sql import functions as F

from textloom.functions import books, cleaners, keys, markup, stems
from textloom.functions import text as t


def apply(spark, values, function, column="v"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, {column} string")
    return [r[1] for r in df.select("i", function(F.col(column)).alias("o")).orderBy("i").collect()]


ODD = [
    "Hello, World!", "  a b\tc \n", "été_1 ½ naïve", "", "#tag x @you http://a.b/c?d=1#e z", "don't stop", None,
    "a [x] b [y\nz] [q]", "x\x1cy z", "1234 a bb ٣٤ ²", "tab\x0bvt\x0cff",
]


def test_words_strip_and_space(spark):
    texts = [v for v in ODD if v is not None]
    assert apply(spark, texts, t.words) == [re.findall(r"\b\w+\b", v) for v in texts]
    assert apply(spark, texts, t.strip) == [v.strip() for v in texts]
    assert apply(spark, texts, t.split_space) == [v.split() for v in texts]
    assert apply(spark, texts, t.collapse_space) == [re.sub(r"\s+", " ", v) for v in texts]
    assert apply(spark, texts, t.remove_sections) == [re.sub(r"\[.*?\]", "", v) for v in texts]
    assert apply(spark, texts, t.remove_punctuation) == ["".join(c for c in v if c not in string.punctuation) for v in texts]


def test_numeric_and_numbers(spark):
    values = ["12", "½", "٣", "", "1a", None, "1.5", "nan", " 7 ", "x"]
    assert apply(spark, values, t.is_numeric) == [str(v).isnumeric() if v is not None else False for v in values]
    assert apply(spark, values, t.to_number) == [12.0, None, None, None, None, None, 1.5, None, 7.0, None]


def test_sentences(spark):
    text = "One two. Three?! ... four"
    assert apply(spark, [text], t.sentence_tokens) == [["one", "two", t.EOS, "three", t.EOS, "four", t.EOS]]


def test_post_and_emoji(spark):
    emoji = {"❤️": ":red_heart:", "❤": ":heart:", "🔥": ":fire:"}
    got = apply(spark, ["Go 🔥! ❤️ ❤ #x http://a.b/c @me", None], lambda c: cleaners.clean_post(c, emoji))
    assert got[1] is None
    assert got[0].split() == ["go", ":fire:", ":red_heart:", ":heart:"]
    lyric = apply(spark, ["[Chorus] I ❤️ the DAY"], lambda c: cleaners.lyric_tokens(c, ["i", "the"], emoji))
    assert lyric == [["redheart", "day"]]


def test_news_and_search_tokens(spark):
    stop = ["not", "i", "can"]
    got = apply(spark, ["I cannot don't 12 wannabe wanna x “Hi”", None], lambda c: cleaners.news_tokens(c, stop))
    assert got == [["dont", "wannabe", "wan", "na", "hi"], []]
    assert apply(spark, ["Oil-price UP 3% été"], lambda c: cleaners.search_tokens(c, ["up"])) == [["oilprice", "t"]]


def test_artist_and_title_keys(spark):
    def artist(a):
        a = re.sub(r"(?i)([a-z])(featuring)", r"\1 \2", a)
        return re.split(r"(?i)\bfeaturing\b|\bwith\b|&|,|x(?=[a-z])", a)[0].strip().lower()

    names = ["Maxwell", "Jamie Foxx Featuring X", "With Confidence", "AFeaturing B", "A & B", "A, B", "Within", "X", " Bo "]
    assert apply(spark, names, keys.artist_key) == [artist(n) for n in names]
    strict = apply(spark, ["Maxwell", "A x B", "Lil X"], lambda c: keys.artist_key(c, "strict"))
    assert strict == ["maxwell", "a", "lil x"]
    titles = ["Hey! (Live) You", "É'té_x", " (a\nb) c", "()"]
    plain = [re.sub(r"[^\w\s]", "", re.sub(r"\(.*?\)", "", v)).strip().lower() for v in titles]
    assert apply(spark, titles, keys.title_key) == plain


def clean_book_in_python(text):
    at = text.find(books.START_MARKER)
    if at >= 0:
        text = text[at + len(books.START_MARKER) :].rstrip()
    lines = text.splitlines()
    head = next((i for i, line in enumerate(lines) if "contents" in line.lower()), 0)
    later = (i for i in range(head + 1, len(lines)) if not 0 < len(lines[i].strip()) <= 100)
    end = next(later, head)
    if head > 0:
        lines = lines[:head] + lines[end + 1 :]
    text = "\n".join(lines)
    at = text.find(books.END_MARKER)
    return text[:at].rstrip() if at >= 0 else text


def test_clean_book(spark):
    start, end = books.START_MARKER + " X ***", books.END_MARKER + " X ***\nlicense"
    bodies = [
        "t\n\nCONTENTS\none\ntwo\n\nChapter\n", "t\r\r\nContents\r\r\none\r\r\ntwo\r\r\n", "contents first\na\n\nb",
        "a\ncontents\nb\nc", "a\ncontents\nb\n" + "w" * 101 + "\nc", "no list\nhere\n\n", "a\x0bContents\x1cx   y",
    ]
    texts = [f"head\n{start}\n{b}\n  \t{end}" for b in bodies] + bodies + ["", "\n", start, f"{end}{start}"]
    assert apply(spark, texts, books.clean_book) == [clean_book_in_python(v) for v in texts]


def test_unescape(spark):
    values = ["a &lt;b&gt; &amp;amp; &quot;q&quot;", "&#65;&#x42;&#x1F600;&#3;&#150;|&#0;", "no entity & here", "&nope; &ltx &#xD800;"]
    assert apply(spark, values, markup.unescape) == [html.unescape(v) for v in values]


def test_attributes_and_tags(spark):
    tag = '<R A="1" b="x y" A="2" c=\'n\'>'
    assert apply(spark, [tag], markup.attributes) == [{"a": "2", "b": "x y"}]
    block = "<T k=\"v\"> a &amp; b </T><T>2</T><E></E>"
    assert apply(spark, [block], lambda c: markup.tag_text(c, "T")) == ["a & b"]
    assert apply(spark, [block], lambda c: markup.tag_text(c, "Z")) == [None]
    assert apply(spark, ["<D>x</D><D>y\nz</D>", None], markup.tag_items) == [["x", "y\nz"], []]


def test_absolute_url(spark):
    links = ["/a/b", "c.html", "../d", "./e", "//h/x", "http://z/q", "?p=1", "#f", "", "a/../b/./c/..", "g?x=../y"]
    bases = ["https://h.example/one/two.html?q=1#z", "http://h.example", "http://h.example/one/"]
    pairs = [(b, link) for b in bases for link in links]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, b string, l string")
    got = [r[1] for r in df.select("i", markup.absolute_url("b", "l")).orderBy("i").collect()]
    assert got == [urljoin(b, link) for b, link in pairs]


STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "caress": "caress", "cats": "cat", "feed": "feed", "agreed": "agre",
    "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl",
    "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail",
    "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit", "rational": "ration",
    "valenci": "valenc", "digitizer": "digit", "conformabli": "conform", "radicalli": "radic", "vileli": "vile",
    "vietnamization": "vietnam", "predication": "predic", "operator": "oper", "feudalism": "feudal", "decisiveness": "decis",
    "formaliti": "formal", "sensibiliti": "sensibl", "triplicate": "triplic", "formalize": "formal", "electrical": "electr",
    "revival": "reviv", "allowance": "allow", "airliner": "airlin", "adjustable": "adjust", "irritant": "irrit",
    "replacement": "replac", "adoption": "adopt", "communism": "commun", "activate": "activ", "effective": "effect",
    "bowdlerize": "bowdler", "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
    "dying": "die", "died": "die", "flies": "fli", "news": "news", "by": "by", "geologi": "geolog",
}


def test_stems(spark):
    df = spark.createDataFrame([(w,) for w in STEMS], "w string")
    got = {r["w"]: r["stem"] for r in stems.with_stems(df, "w").collect()}
    assert got == STEMS


def test_shape_of_long_random_words(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("aybce") for _ in range(rng.randint(1, 9))) for _ in range(300)]

    def consonant(w, i):
        if w[i] in "aeiou":
            return False
        return True if w[i] != "y" or i == 0 else not consonant(w, i - 1)

    assert apply(spark, words, stems.shape) == ["".join("C" if consonant(w, i) else "V" for i in range(len(w))) for w in words]
