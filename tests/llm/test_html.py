import itertools
from collections import Counter

import numpy as np
import pytest

from korrel.llm import html_crf
from korrel.llm.html_blocks import Paths, blocks
from korrel.llm.html_pages import labelled


def texts(page):
    return [b.text for b in blocks(page, Paths())]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", []),
        ("plain &amp; simple", ["plain & simple"]),
        ("<p>a<p>b<ul><li>c<li>d</ul>", ["a", "b", "c", "d"]),
        ("<p>a <b>b</b>c\n\n d<br>e</p>", ["a bc d e"]),
        ("<script>var x='<p>no</p>'</script><style>p{}</style><title>t</title>x<!-- <p>y</p> -->z", ["xz"]),
        ('<a title="a>b" href=x>k</a>', ["k"]),
        ("<td>a<td>b</table></nonsense>c", ["a", "b", "c"]),
        ("a&am", ["a&am"]),
        ("<p>a<!-- open", ["a"]),
        ("<script>open", []),
        ("<P CLASS=x>A</P>&#233;&nbsp;&copy;", ["A", "é ©"]),
        ("1 < 2 <3", ["1 < 2 <3"]),
    ],
)
def test_blocks(page, want):
    assert texts(page) == want


@pytest.fixture(scope="module")
def field():
    return html_crf.trained()


def test_accuracy_on_new_pages(field):
    worker, same, tp, fp, fn = html_crf.Extractor(field), 0, 0, 0, 0
    pages = labelled(250, seed=9)
    for page, article in pages:
        got, want = Counter(worker.article(page).split()), Counter(" ".join(article).split())
        both = sum((got & want).values())
        tp, fp, fn, same = tp + both, fp + sum(got.values()) - both, fn + sum(want.values()) - both, same + (got == want)
    assert tp / (tp + fp) > 0.95 and tp / (tp + fn) > 0.95 and same > 0.85 * len(pages)


def test_viterbi_is_brute_force(field):
    paths = Paths()
    for page, _ in labelled(60, seed=5):
        own = blocks(page, paths)[:9]
        if not own:
            continue
        chain = html_crf._chain(own, paths, {})
        same = [int(paths.parent[a.path] == paths.parent[b.path]) for a, b in zip(own, own[1:], strict=False)]

        def value(y, chain=chain, same=same):
            return sum(float(field.emit[f].sum()) * t for f, t in zip(map(np.array, chain), y, strict=True)) + sum(field.move[s, a, b] for s, a, b in zip(same, y, y[1:], strict=False))

        best = max(itertools.product((0, 1), repeat=len(own)), key=value)
        got = field.label(own, paths, {})
        assert value(got) == pytest.approx(value(best))


def test_frame(spark, field):
    page = "<html><body><nav><a href=/>home</a></nav><article><h1>Head</h1><p>One &lt;two&gt;.</p><div class=ad>Buy.</div><p>Three.</p></article><footer>&copy; x</footer>"
    rows = [(1, "u", page, 1), (1, "u", page, 1), (2, None, None, 2), (None, "v", "", 3), (4, "w", "<p>" * 5000 + "x" * 100_000, 4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = {(r.page_id, r.url): r for r in html_crf.main_text(df).collect()}
    assert got[1, "u"].text == "Head One <two>. Three." and got[1, "u"].n_chars == 22
    assert got[2, None].text == "" and got[None, "v"].n_chars == 0
    assert html_crf.main_text(df).count() == 5 and html_crf.main_text(df.limit(0)).count() == 0


def test_pages_table(spark, sf):
    from pyspark.sql import functions as F

    from korrel.llm.common import read

    docs = read(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("whole"))
    got = html_crf.main_text(read(spark, sf, "pages")).withColumn("id", F.regexp_extract("url", r"/[a-z]{2}/(\d+)", 1).cast("long")).join(docs, "id").collect()
    assert got and sum(r.text.endswith(" ".join(r.whole.split())) for r in got) >= 0.98 * len(got)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<p>a</p><svg><path d=x><p>b</p>", ["a", "b"]),
        ("<header><select><option>o</header><article><p>b</p>", ["o", "b"]),
        ("<p>a</p><template><p>b</p><canvas><p>c</p>", ["a", "b", "c"]),
        ("<object data=x><p>a</p><p>b", ["a", "b"]),
        ("<p>a</p><object><p>b</p></object><noscript><p>c</p></noscript><math><mi>x</mi></math><p>d</p>", ["a", "b", "c", "x", "d"]),
        ("<svg><text>no</text></svg><select><option>no</select><p>a</p>", ["a"]),
        ("<p>a</p><textarea><p>b</p>", ["a"]),
    ],
)
def test_elements_without_a_closing_tag_drop_nothing_else(page, want):
    assert texts(page) == want


def test_likelihood_is_enumeration(field):
    rnd = np.random.default_rng(2)
    chains = [[sorted(rnd.choice(len(html_crf._NAMES), 4, replace=False).tolist()) for _ in range(n)] for n in (3, 1, 5, 3)]
    labels = [rnd.integers(0, 2, len(c)).tolist() for c in chains]
    same = [[0, *rnd.integers(0, 2, len(c) - 1).tolist()] for c in chains]
    emit, move = rnd.normal(size=len(html_crf._NAMES)), rnd.normal(size=(2, 2, 2))

    def exact(emit, move):
        total = 0.0
        for c, y, s in zip(chains, labels, same, strict=True):
            def score(z, c=c, s=s):
                return sum(emit[f].sum() for f, one in zip(c, z, strict=True) if one) + sum(move[s[t], z[t - 1], z[t]] for t in range(1, len(z)))

            total += score(y) - np.logaddexp.reduce([score(z) for z in itertools.product((0, 1), repeat=len(c))])
        return total

    score, g_emit, g_move = html_crf.likelihood(chains, labels, same)(emit, move)
    assert score == pytest.approx(exact(emit, move), abs=1e-4)
    for g, x in ((g_emit, emit), (g_move, move)):
        for at in np.ndindex(x.shape):
            up, down = x.copy(), x.copy()
            up[at] += 1e-4
            down[at] -= 1e-4
            slope = (exact(*((up, move) if x is emit else (emit, up))) - exact(*((down, move) if x is emit else (emit, down)))) / 2e-4
            assert g[at] == pytest.approx(slope, abs=1e-4)


def test_deep_pages_have_their_true_ancestors():
    n, paths = 1000, Paths()
    page = "<nav>" + "<div>" * n + "<p>a</p>" + "</div>" * n + "</nav>" + "<article>" + "<section>" * n + "<p>b</p>" + "</section>" * n + "</article><p>c"
    own = blocks(page, paths)
    assert [b.text for b in own] == ["a", "b", "c"]
    above = []
    for b in own:
        p, tags = b.path, set()
        while p >= 0:
            tags.add(paths.tag[p])
            p = paths.parent[p]
        above.append(tags)
        names = {html_crf._NAMES[k] for k in html_crf.path_features(paths, b.path)}
        assert {n for n in names if n.startswith("above:")} == {f"above:{t}" for t in tags & set(html_crf._ABOVE)}
    assert above == [{"body", "nav", "div", "p"}, {"body", "article", "section", "p"}, {"body", "p"}]


@pytest.mark.parametrize("page", ['<div x="', "<div>", "<svg>", "</x><div>", '<a ">" ', "<ul><div><li></li>", "<!--", "<a<", "<", "&", "<td><option>", "<p><b>x", "<svg/><!x"])
def test_long_malformed_pages_take_linear_time(field, page):
    import time

    worker, size = html_crf.Extractor(field), 1 << 20
    start = time.process_time()
    worker.article((page * (size // len(page) + 1))[:size] + "'")
    assert time.process_time() - start < 10
