import time

import pytest

from textloom.llm.html_text import extract_text, visible_text

CASES = {
    "<p>one<p>two": "one\n\ntwo",
    "<div>a</div><div>b</div>": "a\nb",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "<ul><li>x<li>y<ul><li>z</ul></ul>end": "* x\n* y\n  * z\n\nend",
    "<ol start=9 type=a><li>x<li value=3>y</ol>": "i. x\nc. y",
    "<ol reversed><li>x<li>y</ol><ol type=I><li>q</ol>": "2. x\n1. y\n\nI. q",
    "<ul><li><p>deep</p><p>more</p></ul>": "* deep\n\n  more",
    "<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>": "a    bb\nccc  d",
    "<table><tr><td align=right>1<td>x<tr><td>222<td>y</table>": "1".rjust(3) + "  x\n222  y",
    "<table><tr><td rowspan=2>r<td>1<tr><td>2</table>": "r  1\n   2",
    "<table><tr><td colspan=2>wide one<tr><td>a<td>b</table>": "wide one\na  b",
    "<table><tr><td><table><tr><td>i<td>j</table><td>k</table>": "i  j  k",
    "<table><tr><td>l1<br>l2<td>m</table>": "l1  m\nl2",
    "<table>stray<tr><td>a</table>": "stray\na",
    "<td>loose</td> text": "loose text",
    "<pre>\n a\n\n  b</pre>c": " a\n\n  b\n\nc",
    "x <script>if (a<b) '</p>'</script><style>p{}</style>y": "x y",
    "<p hidden>no<p style='DISPLAY: none'>no<p>yes": "yes",
    "<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b></div>": "yes",
    "<head><title>T</title></head><body>b": "b",
    "a &lt;b&gt; &eacute;&#65;&nbsp;&nbsp;c &amp;amp;": "a <b> éA  c &amp;",
    "a < b <3 c <!-- no --> d <!doctype x> e": "a < b <3 c d e",
    "<dl><dt>T<dd>D<dt>U</dl>": "T\n    D\nU",
    "<blockquote>q</blockquote>r": "    q\n\nr",
    "<b>bold <i>both</b> rest</i>": "bold both rest",
    "in<span>li</span>ne <a href='x>y'>link</a>": "inline link",
    "<textarea>\n<b>raw</b> &amp;</textarea>": "<b>raw</b> &",
    "<noscript>shown</noscript><template>not</template><select><option>o1<option>o2</select>": "shown\no1\no2",
    "<p>a</p>\n\n <p>b</p>   c": "a\n\nb\n\nc",
    "unfinished <a href='": "unfinished",
    "<plaintext><b>x": "<b>x",
    "": "",
    "   \n ": "",
}


@pytest.mark.parametrize("html", list(CASES))
def test_layout(html):
    assert visible_text(html)[0] == CASES[html]


def test_title():
    assert visible_text("<title> a &amp;\n b </title>x") == ("x", "a & b")
    assert visible_text("<svg><title>no</title></svg>x")[0] == "x"
    assert visible_text(None) == ("", None)


def test_no_word_is_lost():
    """Whatever the nesting, words outside of hidden elements all come out, in order."""
    import random

    rng = random.Random(4)
    tags = "p div ul li ol table tr td b i h2 pre span dl dd section br td th tbody a".split()
    for _ in range(300):
        parts, words = [], []
        for n in range(rng.randrange(1, 40)):
            tag = rng.choice(tags)
            kind = rng.random()
            if kind < 0.45:
                parts.append(f"<{tag}>")
            elif kind < 0.65:
                parts.append(f"</{tag}>")
            else:
                words.append(f"w{n}")
                parts.append(f" w{n} ")
        html = "".join(parts)
        got = [w.rstrip(".") for w in visible_text(html)[0].split() if w.startswith("w")]
        assert sorted(got) == sorted(words), html


def test_deep_and_broken_pages_take_linear_time():
    start = time.process_time()
    assert visible_text("<div>" * 20000 + "x")[0] == "x"
    assert visible_text("<p '" * 20000 + "x")[0] == ""
    assert visible_text("<b>" * 20000 + "<p>x")[0] == "x"
    assert "x" in visible_text("<table><tr><td>" * 2000 + "x")[0]
    assert visible_text("word " * 400_000)[0] == ("word " * 400_000).strip()
    assert time.process_time() - start < 60


def test_table(spark, make):
    rows = [(1, "<p>a", "u"), (None, None, "u"), (2, "", "u"), (1, "<p>a", "u")]
    got = extract_text(make(rows, "page_id long, html string, text string")).collect()
    assert sorted((-1 if r.page_id is None else r.page_id, r.title, r.text) for r in got) == [(-1, None, ""), (1, None, "a"), (1, None, "a"), (2, None, "")]
    assert extract_text(spark.createDataFrame([], "page_id long, html string")).collect() == []
