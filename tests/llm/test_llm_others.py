"""Vectors, pages and conversations against brute force and SQL."""

import numpy as np
import pytest

from testbed.check import compare, connect
from waymarks.llm import conversations, embeddings, extract
from waymarks.llm import queries as _registered  # noqa: F401  (fills the registry)
from waymarks.llm.dom import Reader
from waymarks.llm.registry import QUERIES, SQL

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    state, _, _, note = compare(spark, connect(DIR), name, QUERIES[name], SQL[name], DIR)
    assert state == "ok", note


def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 8)
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(12):
        base = rng.normal(size=16)
        for _ in range(rng.integers(1, 12)):
            v = base + rng.normal(size=16) * rng.choice([0.01, 0.08, 0.12])
            rows.append([float(x) for x in v])
    rows += [rows[0], rows[0], [2 * x for x in rows[0]], [0.0] * 16, None]
    rows += [[float("nan")] + rows[1][1:], [float("inf")] + rows[1][1:], rows[1][:8], []]
    data = [(i * 3 % len(rows) if len(rows) % 3 else i, v, 1) for i, v in enumerate(rows)]
    data += [(None, rows[0], 1), data[5]]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>, cid int")
    valid = {
        i: np.array(v)
        for i, v, _ in data
        if i is not None and v and np.isfinite(v).all() and np.any(v)
    }
    links = {
        i: {
            j
            for j, b in valid.items()
            if j != i and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95
        }
        for i, a in valid.items()
    }
    low = {i: i for i, _, _ in data if i is not None}
    for _ in low:
        for i, others in links.items():
            low[i] = min([low[i], *(low[j] for j in others)])
    got = embeddings.near_duplicates(df).collect()
    assert len(got) == len(data)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.n_links, r.component_id) == (len(links.get(r.vec_id, ())), low[r.vec_id])
    assert sum(map(len, links.values())) > 50
    assert embeddings.near_duplicates(df.where("false")).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a = "<p>no</p>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li>Menu</ul></nav>
<div class="cookie-notice">Cookies</div><article><header><h1>Title &amp; more</h1></header>
<div class="ad-slot">Buy</div><p>One&nbsp;<b>bold
text</b><br>line<p>Two <em>it</em>alic<!-- gone <p> --></p><form>Name</form>
<ul><li>first<li>second</ul></article><aside>Side</aside>
<section id="comments"><article>Reader</article></section><footer>Foot</footer></body></html>"""


def test_main_text():
    want = "Title & more\nOne bold text line\nTwo italic\nfirst\nsecond"
    assert Reader().read(PAGE).text() == want
    assert Reader().read(None).text() == "" == Reader().read("").text()
    assert Reader().read("<p>a &lt;b&gt; <").text() == "a <b> <"
    assert Reader().read("<div hidden>x</div><div>y<script>z").text() == "y"


def test_style_tree_drops_what_a_host_repeats(spark):
    def page(i, host):
        html = f"<body><div class='x'>Same on all</div><div class='y'><p>Own {i} text</p></div></body>"
        return (i, f"http://{host}/p{i}", html, "t")

    rows = [page(i, "big.example") for i in range(6)] + [page(7, "small.example")]
    rows += [(8, None, "<p>no url</p>", "t"), (9, "http://big.example/", None, "t"), (None, "x", "<p>a</p>", "t")]
    rows.append(rows[0])
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string")
    got = {r.page_id: r.text for r in extract.extract(df).collect()}
    assert all(got[i] == f"Own {i} text" for i in range(6))
    assert got[7] == "Same on all\nOwn 7 text"
    assert (got[8], got[9], got[None]) == ("no url", "", "a")
    assert extract.extract(df).count() == len(rows)
    assert extract.extract(df.where("false")).count() == 0


def test_repeated_pages_are_one_page_of_the_tree(spark):
    html = '<body><div id="wrap"><article><p>An article that a host has four times.</p></article></div></body>'
    rows = [(i, "http://same.example/", html) for i in range(4)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r.text for r in extract.extract(df).collect()} == {"An article that a host has four times."}


def test_style_tree_equals_brute_force(spark):
    import math
    from collections import Counter, defaultdict

    def page(i):
        notice = "<p class='x'>Sign up for our letter today</p>" if i % 4 else ""
        advert = f"<ul><li>Offer {i % 2}</li></ul>"
        return (f"<body><article><h2>Title {i}</h2><p>Text {i}.</p>{notice}{advert}<p>More {i}</p>"
                f"<section><h3>Always</h3><p>End {i}</p></section></article></body>")

    rows = [(i, "http://h.example/", page(i % 18)) for i in range(20)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    values = defaultdict(lambda: (Counter(), Counter()))
    for html in {page(i) for i in range(18)}:
        first = {}
        for path, tags, content in Reader().read(html).contents():
            first.setdefault(path, (tags, content))
        for path, (tags, content) in first.items():
            values[path][0][tags] += 1
            values[path][1][content] += 1

    def entropy(c):
        n = sum(c.values())
        return -sum(x / n * math.log(x / n) for x in c.values()) / math.log(n)

    want = {path: 0.1 * entropy(a) + 0.9 * entropy(b) for path, (a, b) in values.items()}
    got = {r.path: r.importance for r in extract.importance(df).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want)
    texts = {r.page_id: r.text for r in extract.extract(df, threshold=0.4).collect()}
    assert texts == {i: f"Title {i % 18}\nText {i % 18}.\nMore {i % 18}\nEnd {i % 18}" for i in range(20)}


def test_snapshots_collapse(spark):
    turns = [("a", 0, "user", "hi"), ("a", 1, "bot", "yo")]
    turns += [("b", *t[1:]) for t in turns] + [("b", 2, "user", "more")]
    turns += [("c", 0, "user", "hi"), ("d", 0, None, None), ("e", 0, "unknown", ""), (None, 0, "user", "x")]
    turns += [("f", None, "user", "late"), ("f", 3, "user", "early"), ("g", 3, "user", "early")]
    turns += [("h", *t[1:]) for t in turns if t[0] == "b"] + [("k", 1, "u", "r"), ("k", 1, "u", "r")]
    df = spark.createDataFrame(
        [(*t, 1) for t in turns], "conv_id string, turn int, role string, text string, part int"
    )

    def line(role, text):
        return f"<|im_start|>{role}\n{text}<|im_end|>\n"

    b = line("user", "hi") + line("bot", "yo") + line("user", "more")
    want = {
        "b": b,
        "d": line("unknown", ""),
        "e": line("unknown", ""),
        "f": line("user", "early") + line("user", "late"),
        "k": line("u", "r") * 2,
    }
    for part_turns in (256, 2, 1):
        text = {}
        for r in sorted(conversations.render(df, part_turns).collect(), key=lambda r: r.part):
            text[r.conv_id] = text.get(r.conv_id, "") + r.text
        assert text == want
    assert conversations.render(df.where("false")).count() == 0


def test_each_operator_has_a_query():
    names = [n.split("_")[0] for n in QUERIES if n.startswith("op")]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{i}" for i in range(1, 14)]
    assert "pipeline" in QUERIES
