import pytest

from tastemap.llm import html_text

PAGES = "page_id long, url string, html string"

SIMPLE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{margin:0}</style>
<script>var t="</p>";track(1);</script></head><body><nav><ul><li><a href="/x">Menu</a></li></ul></nav>
<!-- ad <p>no</p> --><div class="ad">Buy this long advert text now, it is really very long indeed, longer than all.</div>
<article><h1>Head &amp; line</h1><p><b>Bold
 start<br>next<p>Second&nbsp;para &lt;x&gt; &#233;&eacute; &unknown; A&B</p>
<div class="comments"><p>Reader says</p></div><form><p>Your mail <input type=text></p></form></article>
<aside>Side</aside><footer>&copy; foot</footer></body></html>"""

NESTED = """<html><body><header><h1>Site</h1></header><div id="cookie-notice">We use cookies</div>
<div class="wrap c12"><div class="main-col"><section><h2>One</h2><p>First long paragraph of the text here.</p></section>
<section><p>Second long paragraph of the text here.</p><ul><li>item a</li><li>item <i>b</i></li></ul></section>
<p class="advert">Buy <b>now</b></p><p>Last &quot;one&quot; <span hidden>secret</span> ends.</p></div>
<div class="sidebar"><p>Short side text</p></div></div><div class=footer>Foot</div></body></html>"""


@pytest.mark.parametrize("html, text", [
    (SIMPLE, "Head & line\nBold start next\nSecond para <x> éé &unknown; A&B"),
    (NESTED, 'One\nFirst long paragraph of the text here.\nSecond long paragraph of the text here.\nitem a\nitem b\n'
             'Last "one" ends.'),
    ("plain words only", "plain words only"), ("", ""), (None, ""), ("<p>", ""), ("<p>a<p>b", "a\nb"),
    ("<div>x <script>if (a<b) {}</script> y</div>", "x\ny"), ("a < b and c > d", "a < b and c > d"),
    ("<table><tr><td>1</td><td>2</td></tr></table>", "1\n2"), ("<div title='a>b' data-x=\"<p>\">in</div>", "in"),
    ("<article>open <b>never closed", "open never closed"), ("<nav>only a menu</nav>", ""),
])
def test_single_pages(html, text):
    assert html_text.main_text(html, ()) == text


def test_deep_and_long_pages():
    assert html_text.main_text("<div>" * 3000 + "deep" + "</div>" * 3000, ()) == "deep"
    body = "".join(f"<p>paragraph {i} &amp; more</p>" for i in range(20_000))
    assert html_text.main_text(f"<article>{body}</article>", ()).count("\n") == 19_999


def test_time_and_memory_follow_the_length_of_a_page():
    import time
    import tracemalloc
    spent, peaks = [], []
    for depth in (10_000, 100_000):
        page = "".join(f'<div class="level k{i}">' for i in range(depth)) + "deep" + "</div></section>" * depth
        tracemalloc.start()
        began = time.process_time()
        assert html_text.main_text(page, ()) == "deep"
        spent.append(time.process_time() - began)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 15 * peaks[0] and peaks[1] < 500e6 and spent[1] < 40 * spent[0]


def test_deep_pages_in_a_table(spark):
    deep = "<div class=a>" * 20_000 + "<p>deep text</p>"
    rows = [(i, "http://d.com/x", deep if i % 2 else "<div class=a><p>flat text</p></div>") for i in range(4)]
    got = {r["id"]: r["text"] for r in html_text.extract_main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: "deep text" if i % 2 else "flat text" for i in range(4)}


def site(path_class, texts, noise):
    body = "".join(f"<p>{t}</p>" for t in texts)
    return f'<html><body><div class="{path_class}">{body}</div><div class="extra">{noise}</div></body></html>'


def test_host_consensus_wins(spark):
    """On one page the other container is longer; its host's other pages outvote it."""
    rows = [(i, f"http://h.com/{i}", site("story", [f"A paragraph of story number {i}."] * 4, "<p>short</p>"))
            for i in range(9)]
    rows += [(100, "http://h.com/odd", site("story", ["Tiny."], "<p>" + "noise " * 200 + "</p>")),
             (101, "http://other.org/odd", site("story", ["Tiny."], "<p>" + "noise " * 200 + "</p>")),
             (102, "http://h.com/none", "<p>no such container</p>"), (103, None, site("story", ["Null url."], "")),
             (104, "http://h.com/x", None), (104, "http://h.com/x", None), (None, "http://h.com/e", "")]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], PAGES + ", text string")
    got = {}
    for r in html_text.extract_main_text(frame).collect():
        got.setdefault(r["id"], []).append(r["text"])
    assert got[100] == ["Tiny."] and got[101] == ["noise " * 199 + "noise"]
    assert got[102] == ["no such container"] and got[103] == ["Null url."]
    assert got[104] == ["", ""] and got[None] == [""]
    assert got[3] == ["\n".join(["A paragraph of story number 3."] * 4)]


def test_join_of_many_hosts_gives_the_same(spark, monkeypatch):
    rows = [(i, f"http://h{i % 5}.com/{i}", site(f"c{i % 3}", [f"Text {i} of the page."] * 3, "<p>x</p>")) for i in range(40)]
    frame = spark.createDataFrame(rows, PAGES)
    a = sorted(map(tuple, html_text.extract_main_text(frame).collect()))
    monkeypatch.setattr(html_text, "BROADCAST_HOSTS", -1)
    assert a == sorted(map(tuple, html_text.extract_main_text(frame).collect()))


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "with-sidebar wrap", "nav-open", "site-header-on"])
def test_wrappers_named_after_boxes_keep_their_article(name):
    page = (f'<html><body><div class="{name}"><div class="text"><p>The long article of this page.</p><p>It goes on.</p>'
            '</div></div><div class="sidebar"><p>Side.</p></div></body></html>')
    assert html_text.main_text(page, ()) == "The long article of this page.\nIt goes on."


def test_comments_longer_than_the_article_stay_out():
    page = ('<html><body><div class="text"><p>A short article.</p></div><div class="comments"><p>' + "A reader says. " * 5
            + '</p></div></body></html>')
    assert html_text.main_text(page, ()) == "A short article."


@pytest.mark.parametrize("limit", [100_000, -1])
def test_every_layout_of_a_host_keeps_its_article(spark, monkeypatch, limit):
    """Five layouts on a host, the smallest on 2 of 102 pages, each with a small box under
    the path of the most frequent."""
    monkeypatch.setattr(html_text, "BROADCAST_HOSTS", limit)
    rows, want = [], {}
    for layout, pages in (("a", 55), ("b", 20), ("c", 15), ("d", 10), ("e", 2)):
        for i in range(pages):
            text = f"The long article {len(rows)} of this page in layout {layout}. " * 5
            box = "" if layout == "a" else '<div class="la"><p>A box.</p></div>'
            want[len(rows)] = text.strip()
            rows.append((len(rows), "http://h.com/x", f'<html><body>{box}<div class="l{layout}"><p>{text}</p></div></body></html>'))
    got = html_text.extract_main_text(spark.createDataFrame(rows, PAGES)).collect()
    assert {r["id"]: r["text"] for r in got} == want


def test_a_long_box_on_short_pages_does_not_win(spark):
    rows = [(i, "http://h.com/x", site("story", [f"Story {i} " * (40 if i else 1)], "")
             .replace("</body>", '<div class="sidebar"><p>A box of the site, always the same.</p></div></body>')) for i in range(9)]
    got = {r["id"]: r["text"] for r in html_text.extract_main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[0] == "Story 0" and got[1].startswith("Story 1")


def test_empty(spark):
    assert html_text.extract_main_text(spark.createDataFrame([], PAGES)).count() == 0
