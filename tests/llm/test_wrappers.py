import itertools
import random

from llm.tables import sentence

from signalwatch.llm import wrappers as op

EXTRA = ", host string, reference string, container string, tree string, node string, hash string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, *"abcdef") for r in rows],
                                 "page_id long, url string, html string" + EXTRA)


def texts(df):
    return {r.page_id: r.text for r in df.collect()}


def page(seed, notice="All offers end soon"):
    body = f"<p>{sentence(seed, 30)}<p>{sentence(seed + 1000, 20)} &amp; so <b>on</b>"
    return (f"<!DOCTYPE html><html><head><title>{sentence(seed, 3)}</title><style>p{{}}</style></head>"
            f"<body><nav><ul><li>{sentence(seed + 5, 1)}</li></ul></nav><!-- ad --><div class='ad'>"
            f"{sentence(seed + 7, 9)}</div><article><h1>{sentence(seed, 4)}</h1>{body}</article>"
            f"<footer>&copy; {notice}</footer>"), "\n".join(
        [sentence(seed, 4), sentence(seed, 30), sentence(seed + 1000, 20) + " & so on"])


def test_articles_of_many_hosts(spark):
    made = {k: page(k) for k in range(90)}
    rows = [(k, f"http://H{k % 4}.org/{k}", html) for k, (html, _) in made.items()]
    assert texts(op.extract(pages(spark, rows))) == {k: text for k, (_, text) in made.items()}


def test_template_is_learned_where_names_say_nothing(spark):
    rows, expected = [], {}
    for k in range(12):
        text = [sentence(k, 30), "The same last words"]
        rows.append((k, "https://plain.net/x", (
            "<body><div><p>Home</p><p>About us</p></div><div><div>Sign our petition, all of you"
            f"</div><p>{text[0]}</p><p>{text[1]}</p></div><div>Imprint and address</div>")))
        expected[k] = "\n".join(text)
    assert texts(op.extract(pages(spark, rows))) == expected


def test_only_the_commonest_text_of_a_template_node_is_left_out(spark):
    rows, expected = [], {}
    for k in range(12):
        text = [sentence(3 * k + j, 20) for j in range(3)]
        rows.append((k, "http://a.net/x", "<body>" + "".join(
            f"<div>{name}<p>{t}</p></div>" for name, t in zip(("News", "Sport", "Local"), text))))
        expected[k] = "\n".join(text)
        notice = sentence(k + 100, 30) if k % 3 == 0 else "No notice today"
        rows.append((k + 50, "http://b.net/x", (
            f"<body><div>{notice}</div><div><p>{text[0]}</p></div><div><p>{text[1]}</p></div>")))
        expected[k + 50] = "\n".join(([notice] if k % 3 == 0 else []) + text[:2])
    assert texts(op.extract(pages(spark, rows))) == expected


def test_articles_behind_long_tables(spark):
    rows, expected = [], {}
    for k in range(9):
        cells = "".join(f"<tr><td>{sentence(200 * k + j, 2)}</td><td>{j}</td></tr>"
                        for j in range(150 + k % 3))
        expected[k] = sentence(k, 20)
        rows.append((k, "http://a.net/x", f"<body><div><table>{cells}</table></div>"
                                          f"<article><p>{expected[k]}</p></article>"))
        # only one page of this host has an article
        rows.append((k + 50, "http://b.net/x", f"<body><div><table>{cells}</table></div>" + (
            f"<article><p>{expected[k]}</p></article>" if k == 4 else "")))
    expected[54] = expected[4]
    found = texts(op.extract(pages(spark, rows)))
    assert {k: found[k] for k in expected} == expected


def test_halved_and_deep_matchings(monkeypatch):
    rng = random.Random(3)
    trees = ["0:a " + " ".join(f"1:{rng.choice('bcd')}" + rng.choice(("", " 2:e", " 2:e 2:f"))
                               for _ in range(40)) for _ in range(8)]
    pairs = list(itertools.combinations(map(op.tree_of, trees), 2))
    expected = [len(op.align(x, y)) for x, y in pairs]
    monkeypatch.setattr(op, "HELD_PAIRS", 6)
    for (x, y), size in zip(pairs, expected):
        found = op.align(x, y)
        assert len(found) == size and sorted(found.values()) == [found[a] for a in sorted(found)]
    deep = " ".join(f"{k}:div" for k in range(5000))
    assert len(op.align(op.tree_of(deep), op.tree_of(deep + " 5000:p"))) == 5000


def test_pages_that_are_all_alike_keep_their_text(spark):
    html = page(1)[0]
    found = op.extract(pages(spark, [(k, "http://a.b/c", html) for k in range(9)]))
    assert set(texts(found).values()) == {page(1)[1]}


def test_awkward_rows(spark):
    long = "<article>" + "".join(f"<p>{sentence(k, 20)}</p>" for k in range(3000)) + "</article>"
    rows = [(1, None, None), (2, "", ""), (3, "no host", "just <i>text</i> 1 < 2"), (None, "x", "y"),
            (4, "http://a.b", "<article><p>one<p>two<br>three&nbsp;four</article"),
            (4, "http://a.b", "<article><p>one<p>two<br>three&nbsp;four</article"),
            (5, "http://a.b", long), (6, "http://a.b", "<nav>menu<article>text"),
            (7, "http://a.b", "<script>var x='</p>';</script><article></article><div>no</div>")]
    found = op.extract(pages(spark, rows))
    assert found.count() == len(rows) - 1
    got = texts(found)
    assert got[1] == got[2] == "" and got[3] == "just text 1 < 2" and got[6] == "text"
    assert got[4] == "one\ntwo three four"
    assert got[5] == "\n".join(sentence(k, 20) for k in range(3000))
    assert all(r.n_chars == len(r.text) for r in found.collect())
    assert op.extract(pages(spark, rows).where("page_id > 99")).count() == 0


def test_excluded_parts():
    html = """<body class="has-sidebar"><header><h1>Site</h1></header><aside>side</aside>
      <div id="cookie-notice">cookies</div><main><h1>Head &lt;1&gt;</h1><form>name</form><p>text
        <script>no()</script>goes <a href="x>y">on</a></p><div class="advert-top">buy</div>
      <section id="comments"><article class="comment">first!</article></section></main>
      <footer>end</footer>"""
    assert op.main_text(op.parse(html), {}, 0, set()) == "Head <1>\ntext goes on"


def largest_matching(x, y):
    """The size of the largest matching that keeps order and ancestors, by trying all."""
    def size(a, b):
        if x[0][a] != y[0][b]:
            return 0
        best = 0
        xs, ys = x[1][a], y[1][b]
        for n in range(1, min(len(xs), len(ys)) + 1):
            for some in itertools.combinations(xs, n):
                for other in itertools.combinations(ys, n):
                    best = max(best, sum(size(i, j) for i, j in zip(some, other)))
        return best + 1

    return size(0, 0)


def test_simple_tree_matching():
    trees = [op.tree_of(t) for t in (
        "0:a 1:b 2:c 1:d 1:b", "0:a 1:d 1:b 2:c", "0:a 1:b 2:c 2:c 3:d 1:b 2:d",
        "0:a 1:b 1:b 2:c 3:d 2:d 1:d", "0:z 1:b")]
    for x, y in itertools.product(trees, trees):
        pairs = op.align(x, y)
        assert len(pairs) == largest_matching(x, y)
        assert all(x[0][a] == y[0][b] for a, b in pairs.items())
        assert sorted(pairs.values()) == [pairs[a] for a in sorted(pairs)]


def test_template_in_articles_is_learned_by_alignment(spark, monkeypatch):
    rows, expected = [], {}
    for k in range(12):
        text = [sentence(k, 4), sentence(k + 50, 30)]
        rows.append((k, "http://a.net/x", (
            f"<body><article><h1>{text[0]}</h1><div>Read this story in our app</div><p>{text[1]}</p>"
            "<div><ul><li>Top stories</li></ul></div></article>")))
        expected[k] = "\n".join(text)
    learned = op.wrappers(pages(spark, rows)).collect()
    assert len(learned) == 1 and len(learned[0].left_out) == 2
    assert texts(op.extract(pages(spark, rows))) == expected
    # without an alignment the template stays
    html = rows[0][2]
    assert "our app" in op.main_text(op.parse(html), {}, -1, set())


def test_names_delete_no_headings_paragraphs_or_parts_of_lines():
    cases = {
        '<article><h2 id="related-work">Related work</h2><p id="social-impact">a</p>'
        '<p class="notice-period">b</p></article>': "Related work\na\nb",
        '<article><p>a <span class="share">30%</span> share</p><li class="menu">c</li>'
        '</article>': "a 30% share\nc",
        "<article><label>l</label><fieldset>f</fieldset></article>": "l\nf",
        "<main><header><h1>Title</h1><p>by me</p></header><p>x</p></main>": "Title\nx",
        "<header><h1>Site</h1></header><main><p>x</p></main>": "x",
        '<article><div class="share">s</div><section id="comments">c</section>x</article>': "x",
    }
    assert {h: op.main_text(op.parse(h), {}, 0, set()) for h in cases} == cases
