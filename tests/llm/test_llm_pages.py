"""Main texts of pages: the given table, hand-made sites, odd pages, and the merged tree against a plain one."""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict

import pytest
from conftest import TESTDATA

import __spark_entry__ as contract
from wearline.llm import site_style_tree as sst
from wearline.llm.html_tree import parse

CLASHING = "host string, importances string, text string, n_chars string, node string"


def frame(spark, rows):
    schema = f"page_id long, url string, html string, {CLASHING}"
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], schema)


def alone(source):
    return sst.main_text(source, {}, sst.Paths())


def article_of(source):
    """The blocks between the article's tags, as the given pages are written."""
    inside = re.search(r"<article>(.*?)</article>", source, re.DOTALL)[1]
    blocks = (html.unescape(re.sub(r"</?b>", "", b)) for b in re.split(r"</?(?:p|h1)>|<br>", inside))
    return "\n".join(" ".join(b.split()) for b in blocks if b.strip())


def test_query_finds_articles(spark):
    found = contract.queries()["op12_site_style_tree"](spark, str(TESTDATA)).collect()
    pages = {r.page_id: r for r in spark.read.parquet(str(TESTDATA / "pages.parquet")).collect()}
    assert len(found) == len(pages)
    for r in found:
        assert (r.url, r.text) == (pages[r.page_id].url, article_of(pages[r.page_id].html))
        assert r.n_chars == len(r.text)


@pytest.mark.parametrize(
    "source, text",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>one<p>two<br>three</p>four", "one\ntwo three\nfour"),
        ("<p>a <b>bold</b>er\n\t word&nbsp;!", "a bolder word !"),
        ("<p>&lt;p&gt; &#65;&#x42; &copy &am; &", "<p> AB © &am; &"),
        ("<ul><li>x<li>y</ul><table><tr><td>1<td>2<tr><td>3</table>", "x\ny\n1\n2\n3"),
        ("<dl><dt>t<dd>d</dl><hr>after<hr>", "t\nd\nafter"),
        ("<P>Upper</P><SCRIPT>var p='</p>';</SCRIPT>x", "Upper\nx"),
        ("<!-- <p>no</p> --><p>yes<!-- no", "yes"),
        ("<style>p{}</style><script>if (a<b) c()</script>t<title>no</title>", "t"),
        ("<script>unclosed <p>no</p>", ""),
        ("</div></p>stray</b> ends", "stray ends"),
        ("a < b and c<d", "a < b and c"),
        ('<p title="a > b">x</p><p title=don\'t>y</p><a href="q', "x\ny"),
        ("<div><span class=x>in <span>line</span></span> text</div>", "in line text"),
        ("<article><header><h1>T</h1></header><p>b</p><footer>f</footer></article><p>beside</p>", "T\nb"),
        ("<header><h1>Site</h1></header><main><p>text</p><aside>s</aside></main>", "text"),
        ("<article>a<article class='comment'>c</article></article>", "a"),
        ("<article>a<div id='comments'><p>c</p></div><div class='share-bar'>s</div></article>", "a"),
        ("<div class=sidebar>s</div><div class='page-header menu'><main>kept</main></div>", "kept"),
        ("<div role=navigation>n</div><div role=main>m</div><form>f<input value=v></form>", "m"),
        ("<div class='advert'>x</div><div class='adventure'>y</div><div class=cookie-notice>z</div>", "y"),
        ("<svg><text>no</text></svg><p>yes</p><noscript>no</noscript><template>no</template>", "yes"),
    ],
)
def test_pages_alone(source, text):
    assert alone(source) == text


def test_deep_and_long_pages():
    depth = 30_000
    assert alone("<div>" * depth + "deep" + "</div>" * depth + "<p>after") == "deep\nafter"
    assert alone("<b class=x>" * depth + "deep") == "deep"
    assert alone("<p>" + "word " * 200_000) == ("word " * 200_000).strip()
    assert alone("<" * 100_000) == "<" * 100_000
    assert alone('<a href="' * 20_000) == alone('<a href="' * 20_000)
    assert alone("<!--" * 50_000) == ""


def site(pages, host="shop.example", first=0):
    """Pages of a host whose parts no name tells apart: a list of links, a slogan, and the text between them."""
    links = "".join(f"<li><a href='/{k}'>Section {k}</a></li>" for k in range(6))
    out = []
    for i in range(pages):
        body = "".join(f"<p>Story {host} {i} part {j}</p>" for j in range(1 + i % 4))
        source = f"<div class=x1><ul>{links}</ul></div><div class=x2>{body}</div><div class=x3><p>Always the same words</p></div>"
        out.append((first + i, f"http://{host}/{i}", source))
    return out


def story(host, i):
    return "\n".join(f"Story {host} {i} part {j}" for j in range(1 + i % 4))


def test_templates_go_by_entropy(spark):
    rows = site(12) + site(2, "tiny.example", 100)
    found = {r.page_id: r.text for r in sst.extracted(frame(spark, rows)).collect()}
    assert {i: found[i] for i in range(12)} == {i: story("shop.example", i) for i in range(12)}
    # Two pages say little about a site, so all of it stays.
    assert all("Always the same words" in found[i] for i in (100, 101))


def test_a_paragraph_on_many_pages_stays(spark):
    rows = [
        (i, u, h.replace("</p></div><div class=x3>", "</p><p>A line that many share</p></div><div class=x3>"))
        for i, u, h in site(12)
    ]
    found = {r.page_id: r.text for r in sst.extracted(frame(spark, rows)).collect()}
    assert found == {i: story("shop.example", i) + "\nA line that many share" for i in range(12)}


def test_copies_of_one_page_keep_their_text(spark):
    rows = [(i, "http://same.example/", "<nav>menu</nav><div><p>only text</p></div>") for i in range(40)]
    assert {r.text for r in sst.extracted(frame(spark, rows)).collect()} == {"only text"}


def test_odd_rows(spark):
    rows = [
        (None, None, None), (1, None, ""), (1, "no host", "<p>x"), (1, "no host", "<p>x"), (2, "http://", "<p>y"),
        (3, "HTTPS://Host.example:80/a?b#c", "<p>" + "long " * 30_000), (4, "http://h/", "<title>t</title>"),
    ]
    found = sst.extracted(frame(spark, rows))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    found = sorted(((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in found.collect()), key=str)
    wanted = [(0, "", "", 0), (1, "", "", 0), (1, "no host", "x", 1), (1, "no host", "x", 1), (2, "http://", "y", 1)]
    wanted += [(3, rows[5][1], ("long " * 30_000).strip(), 149_999), (4, "http://h/", "", 0)]
    assert found == sorted(wanted, key=str)
    assert sst.extracted(frame(spark, [])).collect() == []


def importances_by_hand(pages):
    """The measures from whole pages of one host, by path of looks."""
    paths, styles, contents, on = [], defaultdict(list), defaultdict(lambda: defaultdict(Counter)), defaultdict(set)
    for number, source in enumerate(pages):
        page = parse(source)
        paths = []
        for e in page.elements:
            paths.append(((*paths[e.parent], e.look) if e.parent >= 0 else (e.look,)))
        for e, path in zip(page.elements, paths):
            on[path].add(number)
            if e.children:
                styles[path].append(tuple(paths[c] for c in e.children))
            text = " ".join("".join(e.text).split())
            for value in ([("t", text)] if text else []) + [("r", r) for r in e.references]:
                contents[path][value][number] += 1

    def entropy(counts):
        total = sum(counts)
        return -sum(c / total * math.log(c / total) for c in counts)

    out = {}
    for path, numbers in on.items():
        if len(numbers) < sst.LEAST_PAGES:
            continue
        uses = styles[path]
        style = entropy(Counter(uses).values()) / math.log(len(uses)) if len(uses) > 1 else 1.0
        shared = [entropy(c.values()) / math.log(len(numbers)) for c in contents[path].values()]
        out[path] = (style, 1 - sum(shared) / len(shared) if shared else 1.0)
    return out


def test_merged_tree_is_that_of_whole_pages(spark):
    rows = site(9)
    hosted = frame(spark, rows).withColumn("host", sst.host_of(sst.F.col("url")))
    (row,) = sst.importances(hosted).collect()
    found = sorted((round(x.style, 9), round(x.content, 9)) for x in row.importances)
    wanted = sorted((round(a, 9), round(b, 9)) for a, b in importances_by_hand([h for *_, h in rows]).values())
    assert row.host == "shop.example" and found == wanted


def test_tasks_that_send_counts_early_agree(spark, monkeypatch):
    hosted = frame(spark, site(9)).withColumn("host", sst.host_of(sst.F.col("url"))).coalesce(1)

    def collected():
        (row,) = sst.importances(hosted).collect()
        return {x.node: (round(x.style, 9), round(x.content, 9)) for x in row.importances}

    wanted = collected()
    monkeypatch.setattr(sst, "HELD", 3)
    assert collected() == wanted


def test_extraction_without_broadcast(spark, monkeypatch):
    rows = site(7) + site(7, "other.example", 50)
    wanted = sorted(map(tuple, sst.extracted(frame(spark, rows)).collect()))
    monkeypatch.setattr(sst, "BROADCAST_NUMBERS", -1)
    assert sorted(map(tuple, sst.extracted(frame(spark, rows)).collect())) == wanted
