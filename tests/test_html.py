"""HTML: the parser on broken markup, and selectors against a matcher that looks at every node and ancestor."""

import random
import re

import pytest

from kotonoha.functions import html as h
from kotonoha.operators import html_nodes as hn

PAGE = '<html lang="de"><body><ul id=menu class="a b"><li class=x>eins<li>zwei &amp; <b>drei</b></ul><p>vier<div title="f&quot;g">f<br>s</div></p><script>"<b>no</b>"</script><!-- <i>x</i> --></body>'


def brief(page):
    nodes, text = h.parse(page)
    return [(n.tag, n.parent, n.last, page[n.start : n.stop]) for n in nodes], text


def test_tree_of_a_forgiven_page():
    nodes, text = brief(PAGE)
    assert [n[:3] for n in nodes] == [("html", -1, 9), ("body", 0, 9), ("ul", 1, 5), ("li", 2, 3), ("li", 2, 5), ("b", 4, 5), ("p", 1, 6), ("div", 1, 8), ("br", 7, 8), ("script", 1, 9)]
    assert text == "einszwei & dreivierfs"
    by_tag = {n[0]: n for n in nodes}
    assert by_tag["b"][3] == "drei" and by_tag["script"][3] == '"<b>no</b>"' and by_tag["div"][3] == "f<br>s"


@pytest.mark.parametrize("page, tags", [
    ("", []), ("plain", []), ("</b>", []), ("<", []), ("<>", []), ("<b", ["b"]), ("<b><i>x</b>y</i>", ["b", "i"]), ("<!DOCTYPE html><?x?><!-- <b> ", []), ("<p>a<p>b", ["p", "p"]),
    ("<table><tr><td>1<td>2<tr><td><table><tr><td>3</table></table>", ["table", "tr", "td", "td", "tr", "td", "table", "tr", "td"]), ("<dl><dt>a<dd>b<dt>c</dl>", ["dl", "dt", "dd", "dt"]),
    ("<script>if (a < b) '<p>'", ["script"]), ("<title>a <b></title><b>", ["title", "b"]), ("<a href='x>y'>z</a>", ["a"]), ("<A HREF=X/>", ["a"]), ("<select><option>1<option>2</select>", ["select", "option", "option"]),
])
def test_broken_markup(page, tags):
    nodes, _ = h.parse(page)
    assert [n.tag for n in nodes] == tags
    for n in nodes:
        assert n.open <= n.start <= n.stop <= n.close <= len(page) and n.node <= n.last and n.parent < n.node
        assert n.parent < 0 or nodes[n.parent].last >= n.last
    if page.startswith("<p>a"):
        assert [n.parent for n in nodes] == [-1, -1]


def test_attributes_and_insides():
    assert h.attributes_of(" a=1 B='x y' c=\"&lt;\" d a=2 data-e = f") == {"a": "1", "b": "x y", "c": "<", "d": "", "data-e": "f"}
    assert (h.inner_html("x<p a=b>q<i>r</i></p>s"), h.inner_text("x<p>q<i>&gt;</i></p>s"), h.attribute("<p A='b'>", "a")) == ("q<i>r</i>", "q>", "b")
    assert (h.inner_html("x"), h.inner_text("x"), h.attribute("x", "a")) == ("", "x", "")


def naive(page, selector):
    """Numbers of matching nodes: each node against the whole chain of its ancestors and siblings."""
    nodes, _ = h.parse(page)

    def holds(n, tests):
        def one(t):
            if t.kind == "tag":
                return t.name in ("*", n.tag)
            if t.kind == "child":
                return {"first": n.place == 1, "last": n.place == n.places, "only": n.places == 1, "odd": n.place % 2 == 1, "even": n.place % 2 == 0}.get(t.name, t.name == str(n.place))
            v = n.attributes.get(t.name)
            if v is None or (t.how in ("^=", "$=", "*=", "~=") and not t.value):
                return False
            return {"": True, "=": v == t.value, "~=": t.value in re.split(r"\s+", v), "^=": v.startswith(t.value), "$=": v.endswith(t.value), "*=": t.value in v}[t.how]

        return all(one(t) != t.negated for t in tests)

    def match(n, steps):
        if not holds(n, steps[-1][1]):
            return False
        if len(steps) == 1:
            return True
        relation, rest = steps[-1][0], steps[:-1]
        if relation == " ":
            near, up = [], n.parent
            while up >= 0:
                near.append(nodes[up])
                up = nodes[up].parent
        elif relation == ">":
            near = [nodes[n.parent]] if n.parent >= 0 else []
        else:
            near = [m for m in nodes if m.parent == n.parent and (m.place == n.place - 1 if relation == "+" else m.place < n.place)]
        return any(match(m, rest) for m in near)

    return [n.node for n in nodes if any(match(n, steps) for steps in hn.parse_selector(selector))]


SELECTORS = ["li", "*", "#a1", ".x", "div .x", "div > p", "ul li b", "div div > *", "p + p", "p ~ b", "[id]", "[id^=a]", "[id$='2']", "[class*=y]", "[class~=x]", "li:first-child", "li:last-child > b", "b:only-child",
             "li:nth-child(2)", "li:nth-child(odd)", "p:not(.x)", "div:not([id]) p, b, li.x", "div p + b > i, i", "ul.x#a3 > li[class=y]", "div ~ div p", "body"]


def random_page(rng):
    out = []
    for _ in range(rng.randint(0, 40)):
        tag = rng.choice(["div", "p", "b", "ul", "li", "i", "br"])
        attributes = rng.choice(["", "", f" id=a{rng.randint(1, 3)}", f' class="{rng.choice(["x", "y", "x y", ""])}"', f' class=x id="a{rng.randint(1, 3)}"'])
        out.append(rng.choice([f"<{tag}{attributes}>", f"<{tag}{attributes}>", f"</{tag}>", f"text{rng.randint(0, 9)} ", "<!-- <p> -->", "&lt;"]))
    return "".join(out)


@pytest.fixture(scope="module")
def random_pages(spark):
    rng = random.Random(6)
    rows = [(i, random_page(rng)) for i in range(60)] + [(1000, "<div>" * 300 + "<p>x"), (None, "<p class=x>a"), (7, "<div><p>other</p></div>"), (2000, ""), (2001, None)]
    return rows, spark.createDataFrame([(*r, "t", 5) for r in rows], "page int, html string, tag string, node int").cache()


@pytest.mark.parametrize("selector", SELECTORS)
def test_selectors_against_brute_force(random_pages, selector):
    rows, pages = random_pages
    got = sorted(((r["page"], r["node"]) for r in hn.matching(hn.node_table(pages, "page"), "page", selector).select("page", "node").collect()), key=repr)
    assert got == sorted(((key, n) for key, page in rows if page for n in naive(page, selector)), key=repr)


def test_cut_markup_and_text(random_pages):
    rows, pages = random_pages
    got = sorted((tuple(r) for r in hn.select(pages, "page", "li, div .x").collect()), key=repr)
    want = []
    for key, page in rows:
        nodes, text = h.parse(page or "")
        want += [(key, n, (m := nodes[n]).tag, m.attributes, page[m.open : m.close], page[m.start : m.stop], text[m.text_from : m.text_to]) for n in (naive(page, "li, div .x") if page else [])]
    assert got == sorted(want, key=repr)
    twice = pages.where("page = 3").union(pages.where("page = 3"))
    assert hn.select(twice, "page", "*, div").count() == 2 * hn.select(pages.where("page = 3"), "page", "*").count()
    assert hn.select(pages.limit(0), "page", "*").count() == 0


@pytest.mark.parametrize("selector", ["", ">", "a >", "a,", "a:hover", "a[", "a:nth-child(x)", "a:not(b:not(c))", "a!b"])
def test_selectors_that_are_none(selector):
    with pytest.raises(ValueError):
        hn.parse_selector(selector)


def test_inside_decodes_what_its_sql_decodes(spark, tmp_path):
    from kotonoha import queries

    page = '<!DOCTYPE html><html lang="en"><body><article><h1>a&amp;b &quot;c&quot; d&amp</h1></article></body></html>'
    spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    row = queries.QUERIES["html_inside"](spark, str(tmp_path)).first()
    assert (row["heading_text"], row["heading_html"]) == ("a&b &quot;c&quot; d&amp", "a&amp;b &quot;c&quot; d&amp")
    assert h.parse(page)[1] == 'a&b "c" d&'
