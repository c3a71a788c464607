"""Page text, neighbours and the pipeline."""

from __future__ import annotations

import html
import re
import time

import numpy as np
import pytest

from tests import oracle
from tillroll.llm import ann, htmltext
from tillroll.llm.queries import QUERIES

SF = f"{oracle.DATA}/sf0.001"


@pytest.fixture(scope="module")
def model():
    return htmltext.train("some words that fill pages with lines and more text to read today".split(), layouts=300, epochs=10)


def test_blocks_of_pages_without_end_of_head():
    texts = lambda page: [b.text for b in htmltext.blocks(page)]
    head = "<html><head><meta charset=utf-8><title>t</title><style>s</style> "
    assert texts(f"{head}<body><p>one<p>two</html>") == ["one", "two"]
    assert texts(f"{head}<p>one</p>two</html>") == ["one", "two"]
    assert texts(f"{head}<b>one</b> two<br>three") == ["one two three"]
    assert texts(f"{head}one <i>two</i>") == ["one two"]
    assert texts(f"{head}<head><body>one</body>") == ["one"]
    assert texts(f"{head}<link rel=x></head><body><p>one") == ["one"]
    assert [b.path for b in htmltext.blocks(f"{head}<body><p>one")] == [("html", "body", "p")]


def test_blocks():
    page = (
        "<title>no</title><script>var a='<p>x</p>'</script><!-- <p>no</p> --><div class='a-b' id=c>One <b>two</b>&amp;\n three"
        "<p>four<br>five<p>six<ul><li>s<li>t</ul></div>tail < 5 &lt;"
    )
    found = htmltext.blocks(page)
    assert [b.text for b in found] == ["One two& three", "four five", "six", "s", "t", "tail < 5 <"]
    assert found[0].path == ("div", "a", "b", "c") and found[3].path[-2:] == ("ul", "li")
    assert htmltext.blocks(None) == [] and htmltext.blocks("<p> &nbsp; </p>") == []
    assert htmltext.blocks("<!-- open")[:1] == [] and htmltext.blocks("<script>x") == []


def test_quotes_and_comments():
    texts = lambda page: [b.text for b in htmltext.blocks(page)]
    assert texts("<p title=it's>word </p>" * 2000) == ["word"] * 2000
    assert texts("<p>He said <a href=o'neil.html>x</a> and it's fine</p>") == ["He said x and it's fine"]
    assert texts("<p class=x'y>b") == ["b"] and texts("<p title = 'a>b' id=\"c>d\">e") == ["e"]
    assert texts("<p a=b=\"c>d\">") == ['d">'] and texts("a <b title='x>y") == ["a y"]
    assert texts("<!--> <p>kept?</p>") == ["kept?"] and texts("<!---><p>one") == ["one"]
    assert texts("<p>x<!-- a --!> y</p><p>z</p>") == ["x y", "z"]
    assert texts("<p>1 < 2 <b") == ["1 < 2 <b"]


def test_hostile_pages_take_linear_time():
    start = time.perf_counter()
    for page in ('<a b="' * 10_000, "<a b='" * 10_000 + ">x", "<p a=b" * 10_000, "<!-- " * 10_000, "<" * 10_000):
        htmltext.blocks(page)
    assert time.perf_counter() - start < 1


def test_labeller_gradient():
    rng = np.random.default_rng(0)
    m = htmltext.Labeller(1, width=5, hidden=3)
    m.p = {k: v.astype(float) for k, v in m.p.items()}
    x, mask = htmltext.pad([rng.normal(size=(4, 5)), rng.normal(size=(2, 5))])
    y = rng.integers(0, 2, mask.shape).astype(float)

    def loss():
        z = m.logits(x, mask)
        return ((np.logaddexp(0, z) - y * z) * mask).sum() / mask.sum()

    for k, g in m.gradients(x, mask, y).items():
        at = tuple(rng.integers(0, n) for n in m.p[k].shape)
        keep, e = m.p[k][at], 1e-3
        m.p[k][at] = keep + e
        up = loss()
        m.p[k][at] = keep - e
        down = loss()
        m.p[k][at] = keep
        assert abs((up - down) / (2 * e) - g[at]) < 1e-3, k


def test_unseen_layouts(model):
    layouts, wrong, n = htmltext.Layouts(["other", "fill", "here"], 77), 0, 0
    for _ in range(80):
        page, main = layouts.page()
        found = htmltext.blocks(page)
        if len(found) == len(main):
            wrong += (model.predict([htmltext.vectors(found)])[0] != np.array(main)).sum()
            n += len(main)
    assert wrong / n < 0.03


def test_pages_together_or_alone(model):
    layouts = htmltext.Layouts(["a", "b"], 5)
    pages = [htmltext.vectors(htmltext.blocks(layouts.page()[0])) for _ in range(20)] + [htmltext.vectors([])]
    assert all((a == model.predict([p])[0]).all() for a, p in zip(model.predict(pages), pages))


def test_all_words_of_a_block_count():
    block = lambda text: htmltext.Block(text, ("p",), 0)
    start = " ".join(f"w{i}" for i in range(600))
    a, b = htmltext.vectors([block(f"{start} amber."), block(f"{start} field.")])[:, htmltext.PATH_DIM : -6]
    assert (a != b).any()
    # equal words, however long the block: the sums grow with the root of their number only
    short, long = htmltext.vectors([block("amber " * 12), block("amber " * 1200)])[:, htmltext.PATH_DIM : -6]
    assert np.allclose(long, 10 * short)


def test_pages_query(llm):
    rows = QUERIES["op7_html_text"](llm, SF).toPandas().merge(llm.read.parquet(f"{SF}/pages.parquet").toPandas(), on="page_id")
    same = 0
    for r in rows.itertuples():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1].replace("<br>", " ")
        lines = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
        same += r.text == "\n".join(x for x in lines if x)
        assert r.n_chars == len(r.text)
    assert same / len(rows) > 0.97


def test_odd_pages(llm):
    rows = [(1, "u", None, "x"), (1, "u", "", "x"), (None, None, "<p>" * 3000, "x"), (2, "v", "<article><p>" + "word " * 50_000 + "</p></article>", "x")]
    got = htmltext.extract(llm.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert [r.n_chars for r in got][:3] == [0, 0, 0] and len(got) == 4
    assert htmltext.extract(llm.createDataFrame([], "page_id long, url string, html string")).count() == 0


def brute_neighbours(ids, x, every=100, k=10):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        d[ids == ids[i]] = np.inf
        order = np.lexsort((ids, d))[:k]
        out[int(ids[i])] = [(int(ids[j]), float(d[j])) for j in order if np.isfinite(d[j])]
    return out


def nested(rows):
    out: dict = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_neighbours_recall(llm):
    sf = f"{oracle.DATA}/sf0.1"
    got = nested(QUERIES["op10_nearest"](llm, sf).collect())
    rows = llm.read.parquet(f"{sf}/embeddings.parquet").toPandas().sort_values("vec_id")
    want = brute_neighbours(rows.vec_id.to_numpy(), np.array(rows.embedding.tolist(), float))
    assert got.keys() == want.keys() and all(len(g) == 10 for g in got.values())
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits / (10 * len(want)) > 0.93
    assert all(dict(want[q]).get(v, s) == s for q, g in got.items() for v, s in g)


def test_neighbours_of_odd_rows(llm):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i), 1.0, 0.0], "x") for i in range(0, 6)] + [(i, [5.0, 1.0, 0.0], "x") for i in (100, 101, 102)]
    rows += [(7, None, "x"), (8, [0.0, 0.0, 0.0], "x"), (9, [nan, 1.0, 1.0], "x"), (10, [inf, 1.0, 1.0], "x"), (11, [1.0, None, 1.0], "x")]
    rows += [(12, [1.0], "x"), (None, [1.0, 2.0, 3.0], "x"), (200, None, "x"), (3, [3.0, 1.0, 0.0], "x"), (13, [], "x")]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = nested(ann.search(df).collect())
    ids = np.array([0, 1, 2, 3, 4, 5, 100, 101, 102])
    x = np.array([[min(i, 5), 1, 0] for i in ids], float)
    assert got == brute_neighbours(ids, x)
    assert ann.search(df.where("false")).count() == 0
    assert ann.search(df.where("embedding is null")).count() == 0


def test_many_equal_vectors(llm):
    rows = [(i, [1.0, 2.0] if i % 3 else [float(i), 1.0]) for i in range(1, 2000)] + [(2000, [1.0, 2.0])]
    got = nested(ann.search(llm.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert [v for v, _ in got[2000]] == [v for v in range(1, 20) if v % 3][:10]


@pytest.mark.parametrize("shift,kind", [(0, "double"), (3000, "double"), (3000, "float")])
def test_neighbours_of_repeated_ids_and_hot_vectors(llm, shift, kind):
    """A third of all rows is one vector, 30 rows share one id, one query id has two vectors. With all
    lists probed and many slices only the dimension test could lose anything."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 20)) + 4 * rng.normal(size=(12, 20))[rng.integers(0, 12, 1500)]
    x[rng.choice(1500, 500, replace=False)] = x[7]
    x = (x + shift).astype("f4").astype(float)
    ids = np.arange(1, 1501)
    x, ids = np.vstack([x, x[299:300].repeat(30, 0) + 1e-3, x[40:41]]), np.append(ids, [77] * 30 + [300])
    x = x.astype("f4").astype(float)
    rows = [(int(i), v.tolist()) for i, v in zip(ids, x)]
    df = llm.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(7)
    got = nested(ann.search(df, lists=40, share=1.0).collect())
    want = {}
    for q in range(100, 1501, 100):
        far = np.min([np.sqrt(((x - v) ** 2).sum(1)) for v in x[ids == q]], axis=0)
        least: dict = {}
        for i, d in zip(ids, far):
            if i != q:
                least[int(i)] = min(d, least.get(int(i), np.inf))
        want[q] = sorted(least.items(), key=lambda p: (p[1], p[0]))[:10]
    assert got.keys() == want.keys()
    assert 77 in [v for v, _ in got[300]]
    same = sum(dict(got[q]).get(v) == pytest.approx(d) for q in want for v, d in want[q])
    assert same >= 0.98 * 150
    assert all(len({v for v, _ in g}) == 10 for g in got.values())


def test_probed_share_is_measured(llm):
    """Far clusters need few lists, noise needs most; a list of a third of the rows is cut."""
    rng = np.random.default_rng(6)
    spots = 100 * rng.normal(size=(40, 16))[rng.integers(0, 40, 4000)]
    shares = []
    for x in (spots + rng.normal(size=spots.shape), rng.normal(size=spots.shape)):
        df = llm.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
        q = ann.fit(df)
        chunks = ann.index(df, q)
        sizes = np.zeros(len(q.centroids))
        for r in chunks.groupBy("list").sum("n").collect():
            sizes[r[0]] = r[1]
        assert sizes.sum() == 4000 and len(sizes) == 63
        shares.append(ann.probe_share(chunks, q, sizes))
    assert shares[0] < 0.1 and shares[1] > 0.2
    slices = ann.Probes(q, np.array([10.0] * 9 + [45.0]), 1.0, 10).slices()
    assert slices.tolist() == [1] * 9 + [2]


def test_pipeline(llm):
    import corpus_pipeline as pipeline

    docs = llm.read.parquet(f"{SF}/documents.parquet")
    kinds, seen = docs.dtypes, [docs.count()]
    for name, step in pipeline.STAGES[:-1]:
        docs = pipeline.stage(step(llm, docs, SF), "test-pipeline")
        assert docs.dtypes == kinds, name
        seen.append(docs.count())
    assert seen[0] >= seen[1] >= seen[2] >= seen[3] > 0.7 * seen[0]
    rows = pipeline.STAGES[-1][1](llm, docs, SF).toPandas()
    assert len(rows) == seen[4]
    for _, g in rows.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))


def test_pipeline_stages_on_odd_rows(llm, odd, none):
    import corpus_pipeline as pipeline

    for docs in (odd, none):
        for name, step in pipeline.STAGES:
            left = step(llm, docs, SF)
            if name != "sharding":
                assert left.columns == docs.columns, name
            assert left.count() >= (name == "sharding") * docs.count()
            assert docs.count() or not left.count()
