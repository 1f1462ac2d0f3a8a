import itertools
import random
import time

from shelfspark.llm import html_extract as h

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><header>Site</header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">Cookies</div><article><h1>A &amp; B</h1><p><b>One&nbsp;&nbsp;two<br>three</b><p>F&uuml;r {n}
<form><input>Mail</form><div class="share">Share</div><aside>Side</aside></article>
<section id="comments"><p>c1</p></section><footer>&copy; x</footer></body></html>"""


def test_article():
    assert h.main_text(PAGE.format(n=1), None) == "A & B\nOne two three\nFür 1"


def test_defined_cases():
    assert h.main_text(None, None) == "" and h.main_text("", [1]) == ""
    assert h.main_text("plain < text & more", None) == "plain < text & more"
    assert h.main_text("<p>a<p>b<div>c", None) == "a\nb\nc"
    assert h.main_text("<p title='>'>a</p><script>x", None) == "a"
    assert h.main_text("<main><p>same</p></main>", [h.line_hash("same")]) == "same"
    assert h.main_text("<div>top</div><div>own</div>", [h.line_hash("top")]) == "own"


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment_is_longest():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(15))] for _ in range(2))
        found = sorted(h.shared(a, b))
        assert len(found) == lcs(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in found)  # a subsequence of b


def test_neighbours_equal_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for i in range(120):
        host = rng.choice(["hot.example", "hot.example", "b.example", "c.example"])
        lines = [f"Menu of {host}", f"text {i} {rng.random()}", f"Foot of {host}"]
        rows.append((i, f"https://{host}/s{rng.randrange(4)}/{i}?x=1", "".join(f"<div>{x}</div>" for x in lines)))
    rows += [(500, None, "<p>x</p>"), (501, "http://alone.example/", "<div>Only</div>"), (None, "nonsense", None),
             (502, "https://b.example/s1/z", rows[0][2]), (502, "https://b.example/s1/z", rows[0][2])]
    df = spark.createDataFrame([(*r, 1, "p") for r in rows],
                               "page_id long, url string, html string, k int, path string")
    got = sorted((str(r.page_id), r.url, r.text) for r in h.extract(df).collect())
    keyed = h._keyed(df).collect()
    pages = sorted(({"k": r.k, "host": r.host, "path": r.path, "id": r.page_id, "url": r.url, "html": r.html,
                     "lines": h.open_lines(h.read_lines(r.html)), "whole": True} for r in keyed),
                   key=lambda p: (p["host"], p["path"], p["id"] is not None, p["id"] or 0, p["k"]))
    want = []
    for at, p in enumerate(pages):
        before, after = (pages[j] if 0 <= j < len(pages) else None for j in (at - 1, at + 1))
        want.append((str(p["id"]), p["url"], h.main_text(p["html"], h.choose(p, before, after))))
    assert got == sorted(want)
    texts = {(i, u): t for i, u, t in got}
    own = [t for (i, _), t in texts.items() if i.isdigit() and 0 < int(i) < 120]
    # a page between two of one text that names no article may have no neighbour to learn from
    assert all("text" in t for t in own) and sum("Menu" in t or "Foot" in t for t in own) <= 1
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert h.extract(none).collect() == []


def article_page(i, inside):
    return (i, f"https://site.example/{i:03}", f"<nav>Menu</nav><article><h1>Title {i}</h1><p>Text {i}</p>"
            + "".join(f"<p>{x}</p>" for x in inside) + f"<p>End {i}</p></article>")


def test_neighbours_decide_in_articles(spark):
    """A line without a tell-tale class goes where the pages beside share it, and only there."""
    spread = [article_page(i, ["Read on in our app"] + ["A saying"] * (i % 4 == 0)) for i in range(40)]
    alone = [(100, "https://other.example/1", spread[0][2])]
    df = spark.createDataFrame(spread + alone, "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in h.extract(df.repartition(5)).collect()}
    for i in range(40):
        assert texts[i] == "\n".join([f"Title {i}", f"Text {i}"] + ["A saying"] * (i % 4 == 0) + [f"End {i}"])
    assert texts[100] == "Title 0\nText 0\nRead on in our app\nA saying\nEnd 0"


def test_template_needs_every_witness_and_one_place():
    mine, a, b, c = [1, 2, 3, 9], [4, 2, 5, 9], [6, 2, 7, 9], [2, 8, 9, 9]
    assert h.template_places(mine, [a, b, c]) == [1]  # 9 stands twice in c
    assert h.template_places(mine, [a, b, [8]]) == [] and h.template_places(mine, [a, b]) == []


def test_anchors_in_articles():
    page = "<article><h2 id=related>R</h2><section id=legal><p>L</p></section><section id=comments>C</section>" \
           "<div id=share>S</div><section class=related>T</section></article>"
    assert h.main_text(page, None) == "R\nL"


def test_words_tell_as_a_whole():
    """Classes and ids of an article's own parts keep their text."""
    page = ("<article><div class='entry-header'><h1>Title</h1></div><p class=legal>L</p><section class='social-history'>"
            "<p>S</p></section><ul class=reply><li>R</ul><div class='share-buttons'>x</div><div class='ad slot-2'>x</div>"
            "<div class='postComments'>x</div></article><article class='comment even'><p>x</p></article>")
    assert h.main_text(page, None) == "Title\nL\nS\nR"
    assert h.main_text("<div class='side-by-side'><p>x</p></div><div class=side>y</div>", None) == "x"
    assert h.main_text("<article class='post comments-open'><p>x</p></article>", None) == "x"


def test_formulas_and_unclosed_elements():
    page = "<p>Let <math><mi>x</mi><annotation encoding=tex>\\x</annotation></math> be<svg><text>no</text></svg>.</p>"
    assert h.main_text(page, None) == "Let x be."
    assert h.main_text("<p>a<object data=x></p><p>b</p>" + "<svg>" * 3 + "<p>c", None) == "a\nb\nc"
    assert h.main_text("<p>a</p><p title='b>c</p><p>d</p>", None) == "a\nc\nd"
    assert h.main_text("<p>x <b>y</b> z <span class=ad>no</span>, <i>w<i></i>!</p>", None) == "x y z , w!"
    assert h.main_text("<p>a</p><b", None) == "a\n<b"


def test_time_grows_with_the_page():
    for unit in ("<a \"", "<a '", "<a", "<a \"'>", "<object>", "<div>", "</span>", "<b><p>", "<!-", "<p title='\">"):
        start = time.perf_counter()
        h.read_lines(unit * (1_000_000 // len(unit)) if len(unit) < 5 else unit * 100_000)
        assert time.perf_counter() - start < 8, unit
    start = time.perf_counter()
    h.read_lines("<div>" * 50_000 + "</span>" * 50_000)
    assert time.perf_counter() - start < 8


def test_alignment_is_longest_at_any_size(monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr(h, "MAX_PAIRS", 3)
    for _ in range(300):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(25))] for _ in range(2))
        found = sorted(h.shared(a, b))
        assert len(found) == lcs(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in found)
    monkeypatch.undo()
    a, b = ([rng.randrange(3) for _ in range(6000)] for _ in range(2))
    assert h.shared(a, a) == set(range(6000)) and len(h.shared(a, b)) == int(h._prefix_lengths(a, b)[-1])


def test_template_equals_brute_force(spark):
    """Many short ranges: every page's template lines are those that its nearest pages on either side decide."""
    rng = random.Random(4)
    df = spark.createDataFrame(
        [article_page(i, rng.sample(["App", "Shop", "Club", "Vote"], 3)) for i in range(90)]
        + [(200 + i, f"https://b.example/{i}", "<article><p>same</p></article>") for i in range(5)],
        "page_id long, url string, html string").repartition(9)
    pages = sorted(({"k": r.k, "host": r.host, "path": r.path, "id": r.page_id, "html": r.html,
                     "lines": h.open_lines(h.read_lines(r.html)), "article": h.article_lines(h.read_lines(r.html)),
                     "whole": False} for r in h._keyed(df).collect()), key=lambda p: (p["host"], p["path"], p["id"], p["k"]))
    want = {}
    for at, p in enumerate(pages):
        before, after = ([pages[at + s * d] if 0 <= at + s * d < len(pages) else None for d in range(1, h.REACH + 1)]
                         for s in (-1, 1))
        want[p["id"]] = h.main_text(p["html"], h.choose(p, before[0], after[0]), h.choose_template(p, before, after))
    for ranges in (4, 40):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", ranges)
        try:
            assert {r.page_id: r.text for r in h.extract(df).collect()} == want
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
            spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert any("App" not in t for i, t in want.items() if i < 90)
