"""Language network, decision lists, projection forest, html and MinHash against brute force and held-out rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

llm = pytest.importorskip("loomspark.llm")
from loomspark.llm import components, htmltext, langid, minhash, quality, rpforest  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, row string, band string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), "n", "r", "b") for i, t, lang, s in rows], SCHEMA)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def roots(names, pairs):
    parent = {n: n for n in names}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in names}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 440)] + [(500, 500 + i) for i in range(1, 60)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    want = roots({x for p in pairs if p[0] != p[1] for x in p}, pairs)
    assert got == want
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def brute(rows, k, part, whole):
    def shingle_set(t):
        w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in words(t)]
        return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()

    sets = [shingle_set(t) for _, t, _, _ in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and whole * len(sets[i] & sets[j]) >= part * len(sets[i] | sets[j])]
    root = roots(range(len(rows)), pairs)
    ids = defaultdict(list)
    for i, r in root.items():
        ids[r].append(rows[i][0])
    out = Counter()
    for i, (doc, *_) in enumerate(rows):
        known = [x for x in ids[root[i]] if x is not None]
        component = (min(known) if known else None) if sets[i] else doc
        out[doc, len(sets[i]), component, doc == component] += 1
    return out, root, sets


def near_rows():
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([5, 40, 120]))]
        rows.append((len(rows), " ".join(base), "en", "a"))
        for _ in range(rng.randrange(0, 4)):
            copy = list(base)
            for _ in range(rng.randrange(0, 6)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), ("\n" if i % 2 else " \t ").join(copy).upper() if i % 3 else " ".join(copy), "en", "b"))
    centre = [f"c{i}" for i in range(100)]  # a star: copies are near the centre, not near one another
    rows.append((900, " ".join(centre), "en", "c"))
    for i in range(12):
        rows.append((901 + i, " ".join(f"x{i}" if j in (8 * i % 97, (8 * i + 4) % 97) else w for j, w in enumerate(centre)), "en", "c"))
    rows += [(5, rows[5][1], "en", "a"), (5, "another text with the same id", "en", "a"), (None, rows[6][1], None, None), (None, "an unknown one", None, None), (None, None, None, None), (31, "", "en", "a"), (32, "  \n", "en", "a"), (33, "one", "en", "a"), (34, "ONE", "en", "a"), (35, "word " * 30000, "en", "a"), (36, "word " * 30001, "en", "a")]
    return rows


@pytest.mark.parametrize("k,part", [(3, 85), (5, 80)])
def test_minhash(spark, k, part):
    rows = near_rows()
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(frame(spark, rows), k, (part, 100)).collect())
    assert got == brute(rows, k, part, 100)[0]


def test_minhash_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rows = near_rows()
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(frame(spark, rows), 3, (85, 100)).collect())
    assert got == brute(rows, 3, 85, 100)[0]


def test_minhash_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text, None, None) for r in docs.collect()]
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, 3, (85, 100)).collect())
    assert got == brute(rows, 3, 85, 100)[0]
    assert minhash.near_duplicates(docs.limit(0)).collect() == []


def test_keep_one(spark):
    rows = near_rows()
    out = minhash.keep_one(frame(spark, rows)).collect()
    _, root, sets = brute(rows, 5, 80, 100)
    assert len(out) == len({r for i, r in root.items() if sets[i]}) + sum(not s for s in sets)
    assert set(out[0].asDict()) == set(frame(spark, rows).columns)


def measured(t):
    w = words(t)
    grams = Counter(zip(w, w[1:], w[2:]))
    cover = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), dup, len(cover)


def test_statistics(spark):
    rng = random.Random(2)
    texts = [None, "", " \n\t", "a b c a b c", "a b c\na b c\n\n \nx", "é\x1cü\x85z\xa0q # $ <tag>", "w " * 20000, "a b a b a b a"] + [" ".join(rng.choice("abcdefg") for _ in range(rng.randrange(60))) + rng.choice(["\nx y", ""]) * 2 for _ in range(80)]
    rows = [(i, t, None, None) for i, t in enumerate(texts)] + [(None, "a", None, None), (3, "a b c a b c", None, None)]
    out = quality.statistics(frame(spark, rows)).collect()
    assert Counter((r.doc_id, *(r[c] for c in quality.COUNTS)) for r in out) == Counter((i, *measured(t)) for i, t, _, _ in rows)


def test_decision_list_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    known = labels.where("doc_id % 2 = 0")
    judged = quality.judge(docs, known).join(labels.where("doc_id % 2 = 1"), "doc_id").where("NOT base_failed").collect()
    bad, good = ([r.kept for r in judged if r.quality == q] for q in (0, 1))
    assert len(bad) > 50 and sum(bad) <= 0.05 * len(bad)
    assert sum(good) >= 0.99 * len(good)


def test_learned_rule_is_the_planted_one():
    rng = np.random.default_rng(0)
    x = {"a": rng.random(900), "b": rng.random(900), "c": rng.random(900)}
    bad = ((x["a"] > 0.7) & (x["b"] <= 0.5)) | (x["c"] > 0.93)
    rules = quality.learn(x, bad)
    found = np.zeros(900, bool)
    for rule in rules:
        found |= quality.covers(rule, x, 900)
    assert (found & bad).sum() >= 0.9 * bad.sum() and (found & ~bad).sum() <= 0.02 * (~bad).sum()


def test_quality_edges(spark):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(1, good, "en", "a"), (None, good, "en", "a"), (2, None, None, None), (3, "short", None, None), (1, good, "en", "a"), (4, "a b c " * 40, "en", "a")]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(1, None, 0), (None, 0, 0), (99, 0, 1)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0), None):
        out = quality.judge(docs, known).collect()
        assert Counter((r.doc_id, r.kept) for r in out) == Counter({(1, True): 2, (None, True): 1, (2, False): 1, (3, False): 1, (4, False): 1})
        assert Counter(r.doc_id for r in quality.keep_good(docs, known).collect()) == Counter({1: 2, None: 1})
    assert quality.keep_good(docs, None).columns == docs.columns
    assert quality.judge(docs.limit(0), labels).collect() == []


def test_network_gradients():
    net = langid.Network(["a", "b", "c"], hidden=3)
    x = np.array([[65, 66, 67, langid.PAD], [70, 65, 66, 67]], dtype=np.int16).T
    y = np.array([0, 2])
    _, grad = net.gradients(x, y)
    rng = np.random.default_rng(1)
    for name, g in grad.items():
        for _ in range(6):
            at = tuple(rng.integers(n) for n in g.shape)
            if name.startswith("inputs"):
                at = (int(rng.choice([65, 66, 67, 70])), at[1])
            net.p[name][at] += 1e-5
            up = net.gradients(x, y)[0]
            net.p[name][at] -= 2e-5
            down = net.gradients(x, y)[0]
            net.p[name][at] += 1e-5
            assert g[at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    true = {r.doc_id: r.lang for r in docs.collect()}
    out = langid.identify(docs).collect()
    assert len(out) == len(true)
    for held in (True, False):
        rows = [r for r in out if r.held_out == held]
        assert sum(r.lang_pred == true[r.doc_id] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 and r.n_agree <= r.n_bytes for r in out)
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)


def test_language_ignores_labels_and_ids(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    net = langid.learn(docs)
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.limit(40).collect()]
    a = [r.lang_pred for r in langid.predict(frame(spark, rows), net).orderBy("doc_id").collect()]
    b = [r.lang_pred for r in langid.predict(frame(spark, [(i + 1000, t, "xx", None) for i, t, _, _ in rows]), net).orderBy("doc_id").collect()]
    assert a == b


def test_language_edges(spark):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "123 !!", "en", "a"), (None, "the and of", None, None), (4, "the house and " * 9000, "en", "a"), (5, "le chat est la", "fr", "b"), (5, "le chat est la", "fr", "b")]
    out = langid.identify(frame(spark, rows)).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, *_ in rows)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in out if r.doc_id in (1, 2, 3))
    assert {r.lang_pred for r in out if r.doc_id in (4, 5)} <= {"en", "fr"}
    assert all(r.lang_pred == "und" for r in langid.identify(frame(spark, [(1, "text", None, None)])).collect())
    assert langid.identify(frame(spark, [])).collect() == []


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, embedding array<float>, label int, node int")


def vector_brute(rows, least=0.98):
    good = [i for i, (_, v, lab) in enumerate(rows) if lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    x = {i: np.array(rows[i][1], np.float32).astype(float) for i in good}
    pairs = [(i, j) for i in good for j in good if j < i and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]) and x[i] @ x[j] / np.sqrt((x[i] @ x[i]) * (x[j] @ x[j])) >= least]
    root = roots(range(len(rows)), pairs)
    degree = Counter(k for p in pairs for k in p)
    ids = defaultdict(list)
    for i, r in root.items():
        ids[r].append(rows[i][0])
    out = Counter()
    for i, (vec, *_) in enumerate(rows):
        known = [v for v in ids[root[i]] if v is not None]
        component = min(known) if known else None
        out[vec, degree[i], component, vec == component] += 1
    return out


def test_forest(spark, monkeypatch):
    monkeypatch.setattr(rpforest, "BLOCK", 16)
    rng = np.random.default_rng(4)
    rows = []
    for i in range(250):
        v = rng.standard_normal(32)
        rows.append((len(rows), v.tolist(), int(rng.integers(3))))
        for _ in range(int(rng.integers(0, 3)) if i else 40):
            w = v * rng.uniform(0.5, 2) + rng.standard_normal(32) * rng.choice([0.05, 0.1, 0.2, 0.5])
            rows.append((len(rows), w.tolist(), rows[-1][2] if i % 5 else int(rng.integers(3))))
    rows += [(900, rows[3][1], rows[3][2])] * 2 + [(None, rows[3][1], rows[3][2]), (901, None, 1), (902, [0.0] * 32, 1), (903, [float("nan")] + [1.0] * 31, 1), (904, [None] + [1.0] * 31, 1), (905, rows[3][1], None), (906, [float("inf")] * 32, 1), (907, [], 1), (908, [1.0, 2.0], 1), (909, [2.0, 4.0], 1), (None, None, None)]
    out = rpforest.near_vectors(vectors(spark, rows), leaf=40).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in out) == vector_brute(rows)


def test_forest_recall_and_spread():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((4000, 64))
    y = x + rng.standard_normal(x.shape) * 0.19  # cosine near 0.98
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    x, y = unit(x), unit(y)
    forest = rpforest.Forest(np.concatenate([x, y]), 8000, leaf=100, spill=rpforest.SPILL * 0.2)
    of = lambda v: {(int(r), int(k)) for r, k in zip(*forest.leaves(v))}
    a, b = of(x), of(y)
    found = {r for r, k in a if (r, k) in b}
    close = np.flatnonzero((x * y).sum(1) >= 0.98)
    assert len(close) > 500 and sum(i in found for i in close) >= 0.99 * len(close)
    sizes = Counter(k for _, k in a | {(r + 4000, k) for r, k in b})
    assert max(sizes.values()) < 8000 / 4


def test_forest_empty(spark):
    assert rpforest.near_vectors(vectors(spark, [])).collect() == []
    assert [tuple(r) for r in rpforest.near_vectors(vectors(spark, [(1, None, 1)])).collect()] == [(1, 0, 1, True)]


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<article>no</article>";</script><style>p{{}}</style></head>
<body class="home"><header>Site <b>name</b></header><nav><ul><li><a href="/a">Menu</a></ul></nav><div class="cookie-notice">We use cookies and more cookies here</div>
<div id="wrap"><div class="content post-{n}"><h1>Head &amp; title {n}</h1><p>First <em>para</em>graph,   with
white&nbsp;space and text that is long enough.<p>Second one, <a href="x>y">linked</a>.<br>after break<ul><li>item one</li><li>item &lt;two&gt;</ul>
<div class="ad banner">Buy now</div><form><input type="text">Search this site</form><!-- hidden <p>x</p> --><table><tr><td>cell<td>next</table>
<section class="comments"><p>Reader comment that is long, very long, longer than the article itself, and goes on and on and on and on and on and on.</section></div>
<aside>Side bar</aside><div class="sidebar">More side</div></div><footer>&copy; foot</footer></body></html>"""


def test_html(spark):
    rows = [(i, f"https://a.example/{i}", PAGE.format(n=i)) for i in range(4)] + [(10, "http://b.example", "<p>loose text"), (11, None, None), (12, "x", ""), (None, "http://a.example/z", "<html><body><article><p>Only here &#233;"), (13, "http://a.example/q", "<<< not > html & such"), (0, "https://a.example/0", PAGE.format(n=0))]
    df = spark.createDataFrame([(*r, "h", "p") for r in rows], "page_id long, url string, html string, host string, path string")
    out = htmltext.extract(df).collect()
    assert Counter(r.page_id for r in out) == Counter(r[0] for r in rows)
    texts = {r.page_id: r.text for r in out}
    for i in range(4):
        assert texts[i] == f"Head & title {i} First paragraph, with white space and text that is long enough. Second one, linked. after break item one item <two> cell next"
    assert texts[10] == "loose text" and texts[11] == texts[12] == "" and texts[None] == "Only here é"
    assert all(r.n_chars == len(r.text) for r in out)
    assert htmltext.extract(df.limit(0)).collect() == []
    assert {r.host: r.path for r in htmltext.votes(df).collect() if r.votes == 5} == {"a.example": "/html/body.home/div/div.content.post-#"}


@pytest.mark.parametrize("start", [
    "<html><head><title>T</title><meta charset=x><style>p{}</style><body>", "<head><title>T</title>", "<html><head><script>var a;</script><link rel=x>\n<body class=c>",
])
def test_html_without_head_end(start):
    page = htmltext.Page(start + "<article><p>All of the text</article>")
    assert page.text(page.best()[0]) == "All of the text"


@pytest.mark.parametrize("icon", ['<svg class="i" />', "<svg/>", '<math alttext="x"/>', '<svg width="1">', '<svg><path d="x"/><text>no</text></svg>'])
def test_html_icons(icon):
    page = htmltext.Page(f"<html><head><title>T</title></head><body><article><p>Before {icon}the icon<p>and after</article></body></html>")
    assert page.text(page.best()[0]) == "Before the icon and after"


def test_html_table(spark, sf):
    import html

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    sources = {r.page_id: r.html for r in pages.collect()}
    for r in htmltext.extract(pages).collect():
        body = re.search(r"<article>(.*?)(</article>|<footer>)", sources[r.page_id], re.S)[1]
        body = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br|li|ul)\b[^>]*>", " ", body))
        assert r.text == re.sub(r"\s+", " ", html.unescape(body)).strip()
