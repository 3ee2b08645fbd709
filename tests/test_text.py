import pytest
from pyspark.sql import functions as F

from sahaf.functions import text as T
from sahaf.functions.citations import fill_names, law_references
from sahaf.functions.html import html_to_markdown


def apply(spark, column, text, lang=None):
    row = spark.createDataFrame([(text, lang)], "t string, lang string")
    return row.select(column.alias("x")).first()[0]


t, lang = F.col("t"), F.col("lang")


def test_clean_and_words(spark):
    assert apply(spark, T.clean(t), "Çok İyi, 3x!") == "ok yi x"
    assert apply(spark, T.words(t), " Don't stop ") == ["dont", "stop"]
    assert apply(spark, T.words(t, "unicode"), "Été, déjà vu") == ["été", "déjà", "vu"]
    assert apply(spark, T.document_text(t), None) == ""


def test_sentences_and_tokens(spark):
    text = "One. Two!? \n\nThree (3) ends"
    assert apply(spark, T.sentences(t), text) == ["One.", " Two!?", "Three (3) ends"]
    dated = "Filed 30.04.2008 for 1.250 lira. Dismissed."
    assert apply(spark, T.sentences(t), dated) == ["Filed 30.04.2008 for 1.250 lira.", " Dismissed."]
    many = "1." * 20_000 + "1"
    assert "".join(apply(spark, T.sentences(t), many)) == many
    assert apply(spark, T.tokens(t), "a1 (b), c?") == ["a", "1", "(", "b", ")", ",", "c", "?"]
    assert apply(spark, T.word_chunks(t), "one two, three (four)") == [["one", "two"], ["three"], ["four"]]
    assert apply(spark, T.simple_tokens(t), "A b,C") == ["a", "b,c"]


def test_turkish_case(spark):
    assert apply(spark, T.fold(t, lang), "DIŞ İŞ", "tr") == "dış iş"
    assert apply(spark, T.fold(t, lang), "DIS", "en") == "dis"


@pytest.mark.parametrize(
    "name, word, stem",
    [
        ("en", "working", "work"),
        ("en", "is", "is"),
        ("de", "freiheiten", "frei"),
        ("fr", "nationalités", "national"),
        ("es", "rápidamente", "rápida"),
        ("tr", "mahkemelerinde", "mahkeme"),
        ("xx", "working", "working"),
    ],
)
def test_stems(spark, name, word, stem):
    assert apply(spark, T.stem(t, lang), word, name) == stem


def test_stop_words(spark):
    assert apply(spark, T.is_stop_word(t, lang), "the", "en") is True
    assert apply(spark, T.is_stop_word(t, lang), "the", "tr") is False
    assert apply(spark, T.is_stop_word(t, lang), "ab", "xx") is True


def test_ngrams(spark):
    row = spark.createDataFrame([(["a", "b", "c"],)], "w array<string>")
    rows = row.select(F.explode(T.neighbours(F.col("w"), 3)).alias("r"))
    grams = rows.select(F.explode(T.ngrams(F.col("r"), 2, 3)).alias("g")).select("g.*").collect()
    assert sorted((g.n, g.gram) for g in grams) == [(2, "a b"), (2, "b c"), (3, "a b c")]


def test_preview_and_rendering(spark):
    assert apply(spark, T.preview(t), "x" * 501) == "x" * 500 + "..."
    assert apply(spark, T.preview(t), "x" * 500) == "x" * 500
    assert apply(spark, T.query_text("Türkçe", t), "hırsızlık davası") == "Dil: Türkçe \n hırsızlık davası"
    assert apply(spark, T.fixed(F.lit(1.23456), 3), "") == "1.235"
    assert apply(spark, T.file_stem(t), "/a/b.c/100000000.json") == "100000000"
    assert apply(spark, T.file_stem(t), "noext") == "noext"


def markdown(spark, html):
    return html_to_markdown(spark.createDataFrame([(html,)], "html string")).first()["markdown"]


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<head><title>T</title></head><body><h1>One</h1><p>two</p></body>", "# One\n\ntwo"),
        ("<b><font size=2>9. Hukuk Dairesi</font></b><br>\n<b>x</b>", "**9. Hukuk Dairesi**\n**x**"),
        ("a<script>var t='</p>';</script><!-- c -->b", "ab"),
        ("<ul><li>a</li><li>b<ul><li>c</li></ul></li></ul>", "* a\n* b\n  + c"),
        ("<ol><li>a</li><li>b</li></ol>", "1. a\n2. b"),
        ("<ol><li>a<ul><li>x</li></ul></li><li>b</li></ol>", "1. a\n  + x\n2. b"),
        ("<ol><li>a<ol><li>x</li><li>y</li></ol></li><li>b</li></ol><ol start=\"7\"><li>c</li></ol>", "1. a\n  1. x\n  2. y\n2. b\n\n7. c"),
        ("<pre>\nif a_b:\n    x  *= 2\n</pre> <p>a  b</p><pre class='k'><code>y\n\n\n\nz</code></pre>", "```\nif a_b:\n    x  *= 2\n```\n\na b\n\n```\ny\n\n\n\nz\n```"),
        ("a<pre b", "a<pre b"),
        ("<!-- <pre> -->a\nb<pre>c\nd", "a b\n\n```\nc\nd"),
        ('<a href="/u">text</a> <img src="s.png" alt="pic">', "[text](/u) ![pic](s.png)"),
        ("<i>it</i> <code>c</code><hr>x", "*it* `c`\n\n---\n\nx"),
        ("a_b * c", "a\\_b \\* c"),
        ("<b>open<p>next", "open\n\nnext"),
        ("x &lt; y &amp;amp; &#231;&#xE7; &nbsp;z &#bad;", "x < y &amp; çç z &#bad;"),
        (
            "<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>",
            "| a | b |\n| --- | --- |\n| 1 | 2 |",
        ),
        ("a < b > c", "a < b > c"),
        ("<li>loose</li>", "* loose"),
        ("<pre>code</pre>", "```\ncode\n```"),
        ("&uuml;&ccedil;&eacute; &nosuch; a&b &amp;uuml; &#231;&", "üçé &nosuch; a&b &uuml; ç&"),
    ],
)
def test_html_to_markdown(spark, html, expected):
    assert markdown(spark, html) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("4857 sayılı İş Kanununun 63 üncü maddesinde çalışma süresi", [(4857, "İş Kanunu", 63)]),
        ("5510 sayılı yasanın 15. maddesi", [(5510, "0", 15)]),
        ("1475 sayılı önceki İş Yasasında günlük", [(1475, "İş Yasası", 0)]),
        ("4857 sayılı İş Kanununda 32nci maddenin", [(4857, "İş Kanunu", 32)]),
        ("4721 sayılı Türk Medenî Kanununun 599 uncu maddesinde", [(4721, "Türk Medenî Kanunu", 599)]),
        ("4857 sayılı İş Kanununun 8 inci ve 37 nci maddelerinin", [(4857, "İş Kanunu", 8), (4857, "İş Kanunu", 37)]),
        ("no law here", []),
        ("1475 sayılı Yasa’nın 17, 18 ve 19 uncu maddeleri", [(1475, "0", 17), (1475, "0", 18), (1475, "0", 19)]),
        ("4857 sayılı İş Kanunu'nun 18. maddesi", [(4857, "İş Kanunu", 18)]),
        ("4857 sayılı İş Kanununun 25/II maddesi", [(4857, "İş Kanunu", 25)]),
        ("4857 sayılı İş Kanununun 25/II-e maddesi", [(4857, "İş Kanunu", 25)]),
        ("4857 sayılı Kanunun geçici 6. maddesi", [(4857, "0", 6)]),
        ("1475 sayılı İş Kanununun 8/3. fıkrası", [(1475, "İş Kanunu", 8)]),
        ("1475 sayılı İş Kanununun 8-10 uncu maddeleri", [(1475, "İş Kanunu", n) for n in (8, 9, 10)]),
        ("6100 sayılı HMK'nın 297. maddesi", [(6100, "HMK", 297)]),
        (
            "5510 sayılı Sosyal Sigortalar ve Genel Sağlık Sigortası Kanununun 15. maddesi",
            [(5510, "Sosyal Sigortalar ve Genel Sağlık Sigortası Kanunu", 15)],
        ),
        ("4857 sayılı İş Kanununun 1-150 nci maddeleri", [(4857, "İş Kanunu", n) for n in range(1, 151)]),
        ("4857 sayılı " + "kelime " * 20_000, []),
    ],
)
def test_law_references(spark, text, expected):
    assert [tuple(r) for r in apply(spark, law_references(t), text)] == expected


def test_bare_laws_take_the_usual_name(spark):
    rows = [(1, 4857, "İş Kanunu"), (2, 4857, "0"), (3, 4857, "Is Kanunu"), (4, 4857, "İş Kanunu"), (5, 1, "0"), (6, 0, "0")]
    rows += [(7, 6100, "B"), (8, 6100, "A"), (9, 6100, "0")]
    got = fill_names(spark.createDataFrame(rows, "doc_id int, number int, law string"))
    want = {2: "İş Kanunu", 3: "Is Kanunu", 5: "0", 6: "0", 9: "A"}
    assert {r.doc_id: r.law for r in got.collect() if r.doc_id in want} == want
    assert {r.doc_id for r in got.where("filled").collect()} == {2, 9}


def test_a_sentence_may_hold_any_number_of_decimals(spark):
    text = "Sums: " + " ".join(f"{i}.5" for i in range(5_000)) + ". End."
    assert len(apply(spark, T.sentences(t), text)) == 2
