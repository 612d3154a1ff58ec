import random
from html import unescape
from html.entities import html5

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.functions.html import decode_references, read_elements, strip_markup
from lectern.operators.chunking import chunk_fixed, chunk_sections, chunk_size_sweep, register_chunk_text, split_recursively
from lectern.operators.sections import extract_sections, fetch_text, page_blocks, section_lengths, training_pairs
from tests.conftest import rows

NESTED = """<html><head><title>T</title><script>var a = "</p><section id='no'>";</script></head><body>
<section id="outer"> lead <!-- note --><p>one <b>bold</b></p>
<section id="inner"><p>two</p></section>
<div>three <section id="deep">four</section></div><br>
</section><section><p>no id</p></section><section id="empty"></section></body></html>"""


def pages(spark, *html):
    return spark.createDataFrame([(f"u{i}", h) for i, h in enumerate(html)], "url string, html string")


def sections_of(spark, html):
    return {r["source"]: r["text"] for r in extract_sections(pages(spark, html)).collect()}


def test_nested_sections(spark):
    assert sections_of(spark, NESTED) == {
        "u0#outer": "lead\nnote\none bold\nthree four\n",
        "u0#inner": "two",
        "u0#deep": "four",
        "u0#empty": "",
    }


def test_unclosed_and_stray_tags(spark):
    html = "<section id=a><p>x<p>y</div></section><section id=b>1 &lt; 2 &amp; 3</section>tail"
    assert sections_of(spark, html) == {"u0#a": "xy", "u0#b": "1 < 2 & 3"}


def test_direct_script_counts_nested_does_not(spark):
    html = "<section id=a><script>s()</script><div>t<script>u()</script></div></section>"
    assert sections_of(spark, html) == {"u0#a": "s()\nt"}


def test_blank_strings_between_elements_shrink():
    _, page = read_elements("<div>a</div>  \n  <div>b</div>   <pre>  \n </pre>")
    assert page == "a\nb   \n "


def test_fetch_text(spark):
    html = '<body>head <div id="x">one <p id="y">two</p></div><div id="x">again</div></body>'
    asked = spark.createDataFrame(
        [(1, "u0#x"), (2, "u0#y"), (3, "u0#missing"), (4, "u0"), (5, "other"), (6, "u0#x")], "n int, source string"
    )
    found = {r["n"]: r["source_text"] for r in fetch_text(asked, pages(spark, html)).collect()}
    whole = "head one twoagain"
    assert found == {1: "one two", 2: "two", 3: whole, 4: whole, 5: None, 6: "one two"}


def test_training_pairs(spark):
    asked = spark.createDataFrame([("q", "u0#x")], "question string, source string")
    assert rows(training_pairs(asked, pages(spark, "<i id=x>hi</i>"))) == [("q", "hi")]


def test_page_text_and_blocks(spark):
    df = pages(spark, "<STYLE>p{}</STYLE><h1>T</h1><p class=a>x &amp;lt; y</p><!-- <p>no --><P>z</P><pre>k</pre>").withColumn("page_id", F.lit(7))
    assert df.select(strip_markup(F.col("html"))).first()[0] == "T x &lt; y z k"
    odd = pages(spark, "<p>caf&eacute; &copy; &#8217;&#x41; a&nbsp;&nbsp;b & c</p><p></p><p>&amp;eacute;</p>").withColumn("page_id", F.lit(8))
    assert odd.select(strip_markup(F.col("html"))).first()[0] == "caf\u00e9 \u00a9 \u2019A a b & c &eacute;"
    assert [r["text"] for r in page_blocks(odd).orderBy("pos").collect()] == ["caf\u00e9 \u00a9 \u2019A a b & c", "", "&eacute;"]
    assert [(r["pos"], r["text"]) for r in page_blocks(df).orderBy("pos").collect()] == [(0, "x &lt; y"), (1, "z k")]


def test_section_lengths(spark):
    df = spark.createDataFrame([("ab",), ("abcd",)], "text string")
    assert rows(section_lengths(df)) == [(2, 3.0, 3.0, 3.8, 4)]


# -- chunks ------------------------------------------------------------------------


def test_recursive_split_cases():
    assert split_recursively("short", 10, 2) == ["short"]
    assert split_recursively("", 10, 2) == []
    assert split_recursively("abcdefghij", 4, 1) == ["abcd", "defg", "ghij"]
    assert split_recursively("aa bb cc dd", 5, 2) == ["aa bb", "cc", "dd"]
    assert split_recursively("one\n\ntwo\n\nthree", 9, 0) == ["one\n\ntwo", "three"]
    assert split_recursively("one\ntwo three four", 9, 0) == ["one", "two", "three", "four"]
    assert split_recursively("a b c d e", 5, 2) == ["a b c", "c d", "d e"]
    assert split_recursively("   ", 10, 2) == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n", max_size=200), st.integers(2, 30), st.integers(0, 10))
def test_recursive_split_invariants(text, size, overlap):
    overlap = min(overlap, size - 1)
    chunks = split_recursively(text, size, overlap)
    assert all(0 < len(c) <= size for c in chunks)
    at = 0
    for chunk in chunks:
        assert chunk in text
        found = text.find(chunk, max(0, at - size))
        assert found >= 0
        at = found
    kept = "".join(chunks)
    assert all(kept.count(ch) >= text.count(ch) for ch in "ab")


def test_chunk_sections_copies_source(spark):
    df = spark.createDataFrame([("s", "aaaa bbbb cccc"), ("n", None), ("e", "")], "source string, text string")
    assert rows(chunk_sections(df, 9, 0)) == [("s", 0, "aaaa bbbb"), ("s", 1, "cccc")]


def test_chunks_in_sql(spark):
    register_chunk_text(spark)
    spark.createDataFrame([("s", "aaaa bbbb cccc"), ("n", None)], "source string, text string").createOrReplaceTempView("some_sections")
    found = spark.sql("SELECT source, c.* FROM some_sections, LATERAL chunk_text(text, 9, 0) c")
    assert rows(found) == [("s", 0, "aaaa bbbb"), ("s", 1, "cccc")]


def windows(text, size, overlap):
    starts = [s for s in range(0, max(1, len(text)), size - overlap) if s == 0 or s + overlap < len(text)]
    return [text[s : s + size] for s in starts]


def test_fixed_chunks_against_brute_force(spark):
    texts = ["x" * 0, "abc", "abcdefghij", "a" * 10 + "b" * 7, "q" * 23, "ñandú " * 9]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, text string")
    for size, overlap in ((10, 3), (5, 0), (7, 6)):
        found = [(r[0], r[2]) for r in rows(chunk_fixed(df, size, overlap), "n", "chunk_pos")]
        assert found == [(i, w) for i, t in enumerate(texts) for w in windows(t, size, overlap)]


def test_chunk_size_sweep(spark):
    df = spark.createDataFrame([("a" * 25,), ("b" * 3,)], "text string")
    wanted = []
    for size in (10, 20):
        all_windows = [w for t in ("a" * 25, "b" * 3) for w in windows(t, size, 2)]
        wanted.append((size, len(all_windows), round(sum(map(len, all_windows)) / len(all_windows), 6)))
    assert rows(chunk_size_sweep(df, [10, 20], 2)) == wanted


def test_references_are_decoded_as_the_standard_library_does(spark):
    r = random.Random(4)
    names = list(html5)
    numbers = [0, 1, 9, 10, 11, 13, 31, 38, 127, 128, 129, 150, 159, 160, 233, 0xD800, 0xFDD0, 0xFFFE, 0xFFFF, 0x1F600, 0x1FFFE, 0x10FFFF, 0x110000, 10**9, 10**30, 8364]
    hexes = ["0", "00e9", "1F600", "d800", "110000", "ffffffffff", "80", "9f", "00000000000041", "fdd0", "g", ""]
    odd = ["&", "&&", "& ", "&;", "&#", "&#;", "&#x", "&#x;", "&\t", "&<", "&zzz;", "&notit;", "&copy2", "&ampamp;", "&ltgt;", "&AMP", "&Lt;", "&NotEqualTilde;"]
    plain = ["text", "é 🙂", "a;b", " ", "<b>", "\n", "\r\n", "#", "x&y"]
    kinds = [
        lambda: "&" + r.choice(names),
        lambda: "&" + r.choice(names).rstrip(";") + r.choice(["", "x", "=1", ";", " "]),
        lambda: f"&#{r.choice(numbers)}" + r.choice([";", "", "x"]),
        lambda: f"&#{r.choice('xX')}{r.choice(hexes)}" + r.choice([";", "", "z"]),
        lambda: r.choice(odd),
        lambda: r.choice(plain),
    ]
    texts = ["".join(r.choice(kinds)() for _ in range(r.randrange(1, 9))) for _ in range(4000)] + ["&" + n for n in names]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string")
    decoded = df.select("i", decode_references(F.col("t")).alias("d"))
    assert "Python" not in decoded._jdf.queryExecution().executedPlan().toString()
    found = {x.i: x.d for x in decoded.collect()}
    assert found.pop(len(texts)) is None
    assert [t for i, t in enumerate(texts) if found[i] != unescape(t)] == []
