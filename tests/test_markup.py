"""Trees of broken pages, what is read from them, and JSON-LD of any depth, against hand-made goldens and the json module."""

import json
import random

import pytest

from prospectra.functions import text
from prospectra.operators import structured
from prospectra.sources import markup
from prospectra.sources.markup import Tree


@pytest.mark.parametrize(
    ("html", "lines"),
    [
        ("a<br>b<br/>c", "a\nb\nc"),
        ("<p>one<p>two</div> three", "one\ntwo three"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "a\nb\nc\nd\ne"),
        ("<table><tr><td>a<td>b<tr><th>c</table>", "a\nb\nc"),
        ("x <b> y </b>\n\t z", "x y z"),
        ("<script>no</script><style>no</style><noscript>no</noscript>yes", "yes"),
        ("a &amp; b &lt; &eacute;", "a & b < é"),
        ("<div>a<span>b", "ab"),
        ("</p></div>a<img src=x>b", "ab"),
        ("<!-- no --><![CDATA[x]]>a", "a"),
        ("", ""),
    ],
)
def test_lines(html, lines):
    assert Tree(html).lines(0) == lines


def test_nearest_ancestors():
    t = Tree("<div id=1><table><tr id=2><td><div id=3><a id=4>x</a></div></table><p><a id=5>y</a></p></div><a id=6>z</a>")
    of = {t.attrs[k]["id"]: k for k in range(len(t.tag)) if "id" in t.attrs[k]}
    near = lambda i: t.attrs[t.closest(of[i], "tr", "li", "div")].get("id")
    assert near("4") == "2" and near("5") == "1" and t.closest(of["6"], "tr") == 0
    assert t.within(of["4"], of["1"]) and not t.within(of["6"], of["1"])


def test_unclosed_items_do_not_hold_the_next():
    t = Tree("<ul><li>a<a href='mailto:x'>m</a><li>b</ul>")
    assert [t.lines(k) for k in t.all(lambda tag, _: tag == "li")] == ["am", "b"]


def test_deep_pages():
    t = Tree("<div>" * 20000 + "x" + "</div>" * 20000)
    assert t.lines(0) == "x" and t.closest(20000, "tr") == 19999


def pages_of(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "page_id long, html string")


def test_contexts(spark):
    long = "<div>" + "word " * 500 + "<a href='mailto:long@v.example'>x</a></div>"
    rows = markup.mailbox_contexts(pages_of(spark, None, "", "no tags", "<div>A<div>Bo Lee<br>Chef<a href='mailto: BO@v.example ?x'>w</a></div></div>", long, "<a data-cfemail='zz'>x</a><a data-cfemail='1a'>x</a>"), "page_id").collect()
    got = {r.email: r.context for r in rows}
    assert got["bo@v.example"] == "Bo Lee\nChefw" and len(got["long@v.example"]) == 300 and len(got) == 2


def test_lines_are_trimmed_before_they_are_read(spark):
    df = spark.createDataFrame([("  Ann Lee  \n 5 Main St\n  Chef 7 ",), ("\n",), (None,)], "c string").select(text.context_person("c").alias("p"))
    assert [(r.p.name, r.p.title) for r in df.collect()] == [("Ann Lee", "Chef 7"), ("", ""), ("", "")]


def test_cards_of_nothing(spark):
    args = ("page_id", ("card",), ("head",))
    assert markup.card_rows(pages_of(spark, None, "<p>x", "<div class=card>no head</div>", "<div class=card><b class=head>ab</b></div>"), *args).collect() == []
    twice = "<div class='a card'><p class=head>Same name</p>4.5</div><div class=card><p class=head>Same name</p>3.0</div><b class=head>Loose</b>"
    assert [tuple(r) for r in markup.card_rows(pages_of(spark, twice), *args).collect()] == [(0, "Same name", 4.5, None, 0, "", "")]


def leaves(value, key=None, depth=0):
    if isinstance(value, str):
        yield key, depth, value
    elif isinstance(value, dict):
        for k, v in value.items():
            yield from leaves(v, k, depth + 1)
    elif isinstance(value, list):
        for v in value:
            yield from leaves(v, key, depth + 1)


def made(rng, depth):
    kind = rng.randrange(6) if depth else rng.randrange(4)
    if kind < 2:
        return rng.choice(["a@b.example", "x", "", "mailto:c@d.example", "é\n"])
    if kind == 2:
        return rng.choice([None, True, 1, 1.5e300])
    if kind == 3:
        return rng.choice([[], {}])
    if kind == 4:
        return [made(rng, depth - 1) for _ in range(rng.randrange(4))]
    return {f"k{x}": made(rng, depth - 1) for x in range(rng.randrange(4))}


def test_strings_of_json(spark):
    rng = random.Random(1)
    values = [made(rng, 6) for _ in range(120)]
    rows = [(k, json.dumps(v)) for k, v in enumerate(values)] + [(500, "{bad"), (501, None), (502, ""), (503, '{"a": "x@y.example", "a": "z"}')]
    got = sorted(tuple(r) for r in structured.json_strings(spark.createDataFrame(rows, "id int, j string"), "j").fillna("-", ["key"]).collect())
    assert got == sorted((k, key or "-", depth, s) for k, v in enumerate(values) for key, depth, s in leaves(v))


def test_deep_json(spark):
    df = lambda n: spark.createDataFrame([(1, "[" * n + '"x@y.example"' + "]" * n)], "id int, j string")
    assert [tuple(r) for r in structured.json_strings(df(20), "j").collect()] == [(1, None, 20, "x@y.example")]
    with pytest.raises(ValueError):
        structured.json_strings(df(8), "j", 5)


def test_plain_pages_are_cut_at_once():
    """a tag is parsed once, not once a card; pages that are not plain go to the parser, and both give one tree."""
    card = '<div class="x c"><a href="/p?a=1&amp;b"><b>Ann &amp; Bo</b></a><br/><ul><li> one  two<li>three</ul></div>'
    seen = markup.one_tag.cache_info().misses
    tree = markup.Tree(card * 50)
    assert markup.one_tag.cache_info().misses - seen <= 9
    assert len(tree.all(lambda t, a: a.get("href") == "/p?a=1&b")) == 50
    slow = markup.Tree(card * 50 + "<!-- x -->")
    assert (tree.tag, tree.attrs, tree.parent, tree.lines(0)) == (slow.tag, slow.attrs, slow.parent, slow.lines(0))
    assert markup.Tree("a <b title='x>y'>c</b> < d").lines(0) == "a c < d"
