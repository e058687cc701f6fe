import math
from collections import Counter

from driftline.llm import htmltext as H
from tests.llm.helpers import prose


def test_lenient_reading():
    page = ('<html><body><div class="top-nav">menu</div><div id=content><h1>T &amp; x</h1><p>one<p>two <i>it</i>alic<br>x'
            '<div class="share">s</div><ul><li>a<li>b</ul><form><p>f</p></form><table><tr><td>c1<td>c2</table>tail</div>'
            '<section id="comments"><p>c</p></section><script>if(a<b){"</p>"}</script><p title="a>b">q</p>'
            '<![CDATA[zz]]> 5 < 6 &lt;b&gt;')
    assert H.main_text(page, set()) == "T & x\none\ntwo italic x\na\nb\nc1\nc2\ntail\nq\nzz 5 < 6 <b>"
    assert H.main_text(None, set()) == H.main_text("", set()) == H.main_text("<p> \n</p>", set()) == ""
    assert H.main_text("plain <", set()) == "plain <"
    assert H.main_text("<p>x<!-- c", set()) == "x"
    assert H.main_text("<article><header><h1>H</h1><p>by</p></header><p>t</article><p>out", set()) == "H\nt"
    assert H.main_text("<ul><li>a<ul><li>b</ul><li>c</ul>", set()) == "a\nb\nc"
    assert H.main_text("<p>a&nbsp;&eacute;&#233;&#x41;  b</p>", set()) == "a ééA b"
    assert H.main_text("<style>p{}<p>x</p>", set()) == ""
    long = prose(1, 30_000)
    assert H.main_text(f"<main><p>{long}</p></main><aside>x</aside>", set()) == long


def site(n, host="h.example.org"):
    """Pages whose boilerplate only the site's tree shows: nothing says what it is."""
    return [(i, f"https://{host}/p{i}", f"<body><div class=top><p>Welcome to the site</p></div><div class=x{'y' * (i % 3)}>"
             f"<p>{prose(i, 30)}</p><p>{prose(1000 + i, 20)}</p></div><div class=low><p>All rights {i % 2}</p></div>")
            for i in range(n)]


def test_site_tree_removes_repeated_branches(spark):
    rows = site(40) + [(100, "https://lone.example.org/a", site(1)[0][2]), (101, None, "<p>no host"), (102, "x", None),
                       (103, "https://h.example.org/q", ""), (103, "https://h.example.org/q", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumnRenamed("page_id", "id") \
        .selectExpr("id as page_id", "url", "html", "1 as host", "2 as main_text_", "3 as node")
    got = {r.page_id: r.main_text for r in H.extract(pages, ["page_id", "host", "node"]).collect()}
    for i in range(40):
        assert got[i] == f"{prose(i, 30)}\n{prose(1000 + i, 20)}"
    assert got[100].startswith("Welcome") and got[101] == "no host" and got[102] == got[103] == ""
    assert H.extract(pages, ["page_id"]).count() == len(rows)
    assert H.extract(pages.limit(0), ["page_id"]).count() == 0


def test_words_drop_no_article_and_no_bulk_of_the_text():
    body = prose(2, 30)
    for page in (f'<div class="content-sidebar-wrap"><article><p>{body}</p></article></div>',
                 f'<main class="no-sidebar"><p>{body}</p></main>', f'<article class="category-legal"><p>{body}</p></article>',
                 f'<div id="page" class="has-header"><p>{body}</p></div>'):
        assert H.main_text(f'<div class="sidebar"><p>links</p></div>{page}', set()) == body


def test_elements_inside_a_line():
    wrap = lambda x: H.main_text(f"<article>{x}<p>end</p></article>", set())
    for gone in ("<button>Click me</button>", "<span hidden>h</span>", '<span style="display:none">h</span>',
                 '<span class="advert">buy</span>', "<svg><text>t</text><title>s</title></svg>",
                 "<noscript>enable scripts</noscript>", "<noscript><p>enable</p><p>scripts</p></noscript>",
                 "<math><mi>x</mi></math>", "<textarea>type</textarea>", "<button><div>Click</div>me</button>",
                 "<select><option>o1</option><option>o2</select>", "<script>x<y</script>", '<i aria-hidden="true">h</i>'):
        assert wrap(f"<p>before {gone} after</p>") == "before after\nend", gone
        assert wrap(f"<div>before {gone} after</div>") == "before after\nend", gone
        assert wrap(f"<p>a{gone}<p>b") == "a\nb\nend", gone
        # an advert is told by its share of the text, so it needs more than "end" beside it
        assert wrap(f"<p>{gone}</p><p>some more text</p>") == "some more text\nend", gone
    assert wrap("<p>wo<script>x</script>rd a<button>x</button>b</p>") == "word a b\nend"
    # ends that are missing take no text with them
    assert wrap("<p>a <button>Click</p><p>b</p>") == "a\nb\nend"
    assert wrap("<ul><li>a <button>x<li>b</ul>") == "a\nb\nend"
    assert wrap("<p>a <span hidden>h<p>b</p>") == "a\nb\nend"
    # words that name no advert count for blocks only
    assert wrap('<p>see <a class="follow">the link</a> and <span class="comment"># code</span></p>') \
        == "see the link and # code\nend"
    assert wrap('<span class="sidebar"><div>links</div></span><p>a longer text</p>') == "a longer text\nend"
    assert H.main_text('<p><span class="advert">all there is</span></p>', set()) == "all there is"
    assert H.main_text("<p>a &amp;<i>amp;</i> b<textarea>t", set()) == "a &amp; b"


def test_parts_of_papers():
    a, b, c = prose(21, 30), prose(22, 12), prose(23, 12)
    page = (f'<article><p>{a}</p><section class="related-work"><p>{b}</p></section><section class="discussion"><p>{c}</p>'
            '</section><section class="related"><p>more</p></section><div class="discussion comments"><p>first!</p></div>'
            "</article>")
    assert H.main_text(page, set()) == f"{a}\n{b}\n{c}"
    assert H.main_text(f'<p>{a}</p><section class="discussion"><p>{c}</p></section>', set()) == a


def test_short_texts_under_long_templates():
    menu, text = prose(3, 60), "a short but whole article"
    page = f"<body><div class=top><p>{menu}</p></div><div class=x><p>{text}</p></div>"
    top, low = ({b.keys for b in H.parse(page)[0] if b.text == x}.pop() for x in (menu, text))
    assert H.main_text(page, {top[-1]}) == H.main_text(page, {top[0], top[-1]}) == text
    assert H.main_text(page, {top[-1], low[-1]}) == f"{menu}\n{text}"
    marked = f"<body><div class=top><p>{menu}</p></div><article><h1>T</h1><p>{text}</p></article>"
    article = next(b.main for b in H.parse(marked)[0] if b.main)
    assert H.main_text(marked, set()) == H.main_text(marked, {article}) == f"T\n{text}"


def test_blocks_of_a_small_part_of_a_large_host(spark):
    rows = [(i, f"https://big.example.org/{i}", f"<body><div class=a><p>{prose(i, 20)}</p></div>"
             + ("<div class=note><p>the same notice</p></div>" if i < 10 else "")) for i in range(1200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.main_text for r in H.extract(pages, ["page_id"]).collect()}
    assert got == {i: prose(i, 20) for i in range(1200)}


def test_identical_articles_are_kept(spark):
    rows = [(i, "https://same.example.org/", f"<article><p>{prose(5, 40)}</p></article>") for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.main_text for r in H.extract(pages, ["page_id"]).collect()} == {prose(5, 40)}


def test_importance_against_the_formula(spark):
    rows = site(30)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.branch: r.importance for r in H.branch_importance(
        pages.select(H.host(pages.url).alias("host"), "html")).collect()}
    parsed = [H.parse(h) for _, _, h in rows]
    texts, below, styles, on = {}, {}, {}, Counter()
    for blocks, shown in parsed:
        nodes = {k for b in blocks for k in b.keys}
        on.update(nodes)
        for b in blocks:
            texts.setdefault(b.keys[-1], Counter())[b.text] += 1
            for k in b.keys:
                below.setdefault(k, set()).add(b.keys[-1])
        for k, s in shown.items():
            styles.setdefault(k, Counter())[s] += 1
    for k in on:
        m = math.log(on[k])
        leaf = {x: (sum(c.values()), max(0.0, 1 - sum(n * math.log(n) for n in c.values()) / (sum(c.values()) * math.log(on[x]))))
                for x, c in texts.items()}
        content = sum(leaf[x][0] * leaf[x][1] for x in below[k]) / sum(leaf[x][0] for x in below[k])
        c = styles.get(k, Counter())
        total = sum(c.values())
        shown = -sum(n / total * math.log(n / total) for n in c.values()) / m if total else 1.0
        g = H.G ** len(c)
        assert abs(got[k] - ((1 - g) * shown + g * content)) < 1e-9
