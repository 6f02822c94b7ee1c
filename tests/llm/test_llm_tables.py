"""Operators on whole tables against SQL and brute force."""

import math
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
import zstandard
from compare import database, differences
from llm_data import documents, rows
from pyspark.sql import functions as F

import corpus_pipeline
from tidemart.llm import components, embeddings, katz, labelled_pages, mixing, pages, quality, secrets, simhash, warc
from tidemart.llm.oracles import ORACLES
from tidemart.llm.queries import QUERIES


@pytest.mark.parametrize("name", ORACLES)
@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_same_as_sql(name, folder, spark):
    path = f"/root/testdata/{folder}"
    assert differences(QUERIES[name](spark, path), database(path), ORACLES[name]) == []


def test_mix_edges(spark):
    docs = documents(spark)
    out = mixing.mix(docs, keep=("size", "key")).collect()
    assert len(out) == len(rows())
    sizes, taken, targets = Counter(), Counter(), {}
    by_id = defaultdict(list)
    for r in rows():
        by_id[r[0]].append((r[3], len((r[1] or "").encode().split())))
    for r in out:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["row"] is not None
        assert len(r["positions"]) == (r["taken"] > 0) + (r["taken"] > r["size"])
        assert all(0 <= p <= 1 for p in r["positions"]) and r["positions"] == sorted(r["positions"])
        source = next(s for s, n in by_id[r["doc_id"]] if n == r["size"])
        sizes[source] += r["size"]
        taken[source] += r["taken"]
        targets[source] = r["target"]
    assert len(targets) == 5
    # by weight, stopped at twice the size, the rest again by weight
    order = [*sorted(s for s in sizes if s is not None), None]
    weight = dict(zip(order, [5, 2, 1, 5, 2]))
    expected, open_, rest = {}, set(order), 1.5 * sum(sizes.values())
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= 2 * sizes[s]}
        if not full:
            expected |= {s: weight[s] * level for s in open_}
            break
        expected |= {s: 2.0 * sizes[s] for s in full}
        rest -= sum(2 * sizes[s] for s in full)
        open_ -= full
    for s in order:
        assert targets[s] == pytest.approx(expected[s]) and abs(taken[s] - targets[s]) <= 0.5
    assert Counter((*r[1:-1], tuple(r[-1])) for r in mixing.mix(docs, prefix=1).collect()) == Counter((*r[1:-1], tuple(r[-1])) for r in out)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_training_order(spark):
    docs = documents(spark)
    order = mixing.training_order(docs)
    assert order.schema == docs.schema
    copies = Counter(r["doc_id"] for r in order.collect())
    expected = Counter()
    for r in mixing.mix(docs).collect():
        expected[r["doc_id"]] += len(r["positions"])
    assert copies == +expected


def test_schedule_inverse(spark):
    for knots in mixing.SCHEDULES:
        area = lambda t, ks=knots: sum((min(t, b) - a) * (v + v + (w - v) * (min(t, b) - a) / (b - a)) / 2 for (a, v), (b, w) in zip(ks, ks[1:]) if t > a)
        parts = [i / 20 for i in range(21)]
        got = spark.createDataFrame([(p,) for p in parts], "p double").select("p", mixing.time_of(F.col("p"), knots).alias("t")).collect()
        for r in got:
            assert area(r["t"]) / area(1.0) == pytest.approx(r["p"], abs=1e-9)


def katz_by_hand(texts, held, n_max, k=5):
    """Scores by plain recursion over dictionaries."""
    tokens = {i: [0, *(t or "").encode().lower().split(), 1] for i, t in texts.items()}
    counts = [None] + [Counter() for _ in range(n_max)]
    for i, t in tokens.items():
        for n in range(1, n_max + 1):
            for j in range(max(1, n - 1), len(t)):
                if not held[i]:
                    counts[n][tuple(t[j - n + 1 : j + 1])] += 1

    def factors(c):
        n_r, d = Counter(c.values()), {}
        tail = (k + 1) * n_r[k + 1] / n_r[1] if n_r[1] else 1
        for r in range(1, k + 1):
            if tail < 1 and n_r[r] and 0 < (x := ((r + 1) * n_r[r + 1] / (r * n_r[r]) - tail) / (1 - tail)) < 1:
                d[r] = x
        return d

    d = [None] + [factors(c) for c in counts[1:]]
    total, distinct = sum(counts[1].values()), len(counts[1])
    left = sum((1 - d[1].get(c, 1)) * c for c in counts[1].values())
    followers = [None, None] + [defaultdict(list) for _ in range(2, n_max + 1)]
    for n in range(2, n_max + 1):
        for g in counts[n]:
            followers[n][g[:-1]].append(g)

    def p(g):
        n, c = len(g), counts[len(g)][g]
        if n == 1:
            return d[1].get(c, 1) * c / (total if left > 0 else total + 1) if c else (left / total if left > 0 else 1 / (total + 1))
        known = followers[n].get(g[:-1], [])
        if not known:
            return p(g[1:])
        all_, off = sum(counts[n][x] for x in known), sum((1 - d[n].get(counts[n][x], 1)) * counts[n][x] for x in known)
        whole = all_ if off > 0 else all_ + 1
        if c:
            return d[n].get(c, 1) * c / whole
        return (off if off > 0 else 1) / whole / (1 - math.fsum(p(x[1:]) for x in known)) * p(g[1:])

    out = {}
    for i, t in tokens.items():
        seen = [counts[1][(w,)] for w in t[1:]]
        out[i] = (
            held[i], len(t) - 1, sum(c > 0 for c in seen), total, sum(math.log10((c + 0.5) / (total + 0.5 * (distinct + 1))) for c in seen),
            sum(math.log10(p(tuple(t[max(0, j - n_max + 1) : j + 1]))) for j in range(1, len(t))),
        )
    vocabulary = [g[0] for g in counts[1]]
    contexts = [g[:-1] for g in list(counts[2])[:5]] + [(b"nowhere",)]
    for c in contexts:  # words and one unknown word share everything
        assert math.fsum(p((*c, w)) for w in [*vocabulary, b"never seen"]) == pytest.approx(1)
    return out


@pytest.mark.parametrize("how", [katz.Order(), katz.Order(n=3, chunk_bytes=4000, bucket_tokens=300), katz.Order(n=1, chunk_bytes=20000), katz.Order(n=2, chunk_bytes=3000, bucket_tokens=64)])
def test_katz(spark, how):
    texts = {i: r[1] for i, r in enumerate(rows())}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in texts.items()], "doc_id long, text string, chunk string, bucket int").repartition(3)
    out = katz.score(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, how).collect()
    expected = katz_by_hand(texts, held, max(2, how.n)) if how.n > 1 else {i: v for i, v in katz_by_hand(texts, held, 2).items()}
    assert len(out) == len(texts)
    for r in out:
        e = expected[r["doc_id"]]
        assert tuple(r)[1:5] == e[:4] and r["base_score"] == pytest.approx(e[4])
        if how.n > 1:
            assert r["score"] == pytest.approx(e[5])


def test_katz_without_training(spark):
    docs = documents(spark)
    out = katz.score(docs, F.lit(True)).collect()
    assert len(out) == len(rows()) and all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["score"] == 0 for r in out)
    assert katz.score(docs.limit(0), F.lit(False)).count() == 0


def test_katz_leaves_no_table(spark):
    before = spark.catalog.listTables()
    katz.score(documents(spark), F.lit(False)).count()
    assert spark.catalog.listTables() == before


def test_katz_query(spark, small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    expected = katz_by_hand(texts, {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}, 2)
    for r in QUERIES["op5_katz_backoff"](spark, small).collect():
        e = expected[r["doc_id"]]
        assert tuple(r)[1:5] == e[:4] and tuple(r)[5:] == pytest.approx(e[4:])


def test_discounts():
    d = katz.discounts([100.0, 40.0, 20.0, 12.0, 8.0, 5.0], 5)
    tail = 6 * 5 / 100
    assert d[1] == pytest.approx((2 * 40 / 100 - tail) / (1 - tail)) and d[6] == 1
    assert katz.discounts([0.0] * 6, 5).tolist() == [1.0] * 7


def smallest_reachable(ids, near):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in near:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(x, least.get(find(i), x))
    return [least.get(find(i)) for i in range(len(ids))]


def fingerprint_by_hand(text):
    words = [w.decode() for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_edges(spark):
    table = rows()
    prints = [fingerprint_by_hand(r[1]) for r in table]
    near = [(i, j) for i in range(len(table)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 2]
    expected = Counter(zip((r[0] for r in table), (f"{p:016x}" for p in prints), smallest_reachable([r[0] for r in table], near)))
    assert Counter(tuple(r) for r in simhash.near_duplicates(documents(spark)).collect()) == expected
    assert simhash.near_duplicates(documents(spark).limit(0)).count() == 0


def test_simhash_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    prints = [fingerprint_by_hand(r["text"]) for r in docs]
    near = [(i, j) for i in range(len(docs)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 2]
    expected = dict(zip((r["doc_id"] for r in docs), smallest_reachable([r["doc_id"] for r in docs], near)))
    assert {r["doc_id"]: r["component_id"] for r in QUERIES["op6_simhash_bitsliced"](spark, small).collect()} == expected


@pytest.mark.parametrize("tile", [4, 16, 8192])
def test_simhash_large_groups(spark, tile):
    """Chains and dense groups, cut into tiles, against all pairs."""
    r = np.random.default_rng(5)
    words = [int(x) for x in r.integers(0, 1 << 63, 60)]
    for start in words[:3]:
        word = start
        for _ in range(25):
            word ^= 1 << int(r.integers(0, 64))
            words.append(word)
        words += [start ^ (1 << int(a)) ^ (1 << int(b)) for a, b in r.integers(0, 20, (30, 2))]
    signed = [simhash.signed(w) for w in dict.fromkeys(words)]
    near = [(i, j) for i in range(len(signed)) for j in range(i) if bin((signed[i] ^ signed[j]) & (1 << 64) - 1).count("1") <= 2]
    prints = spark.createDataFrame([(i, w) for i, w in enumerate(signed)], "doc_id long, fp long")
    got = {x["fp"]: x["component_id"] for x in simhash.groups(prints, tile=tile).collect()}
    assert [got[w] for w in signed] == smallest_reachable(list(range(len(signed))), near)


def test_bit_planes_count_bits():
    r = np.random.default_rng(6)
    for radius in (0, 1, 2, 3, 6):
        words = r.integers(0, 1 << 63, 700, dtype=np.uint64) & r.integers(0, 1 << 63, 700, dtype=np.uint64) & r.integers(0, 1 << 63, 700, dtype=np.uint64)
        words[::5] = [1 << int(b) for b in r.integers(0, 64, 140)]
        assert (simhash.within(words, radius) == (np.bitwise_count(words) <= radius)).all()


def test_keep_one(spark):
    docs = documents(spark)
    kept = simhash.keep_one(docs)
    assert kept.schema == docs.schema
    prints = simhash.fingerprints(docs).select(F.col("key").alias("doc_id"), "fp")
    roots = {r["root"]: r["component_id"] for r in simhash.groups(prints).collect()}
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(roots.values())


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1050)] + [(5, 5), (700, 600)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1050)} | {600: 600, 700: 600}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def vector_rows():
    r = np.random.default_rng(8)
    out, centres = [], r.normal(size=(8, 24))
    for i in range(160):
        v = centres[i % 8] + r.normal(size=24) * (0.02 if i % 3 else 0.25)
        out.append((i, [float(np.float32(x)) for x in v], i % 2))
    out += [(1000 + i, out[8][1], 0) for i in range(6)] + [(out[3][0], out[3][1], 1)]
    nan, inf = float("nan"), float("inf")
    return out + [(2000, None, 1), (2001, [0.0] * 24, 1), (2002, [nan] * 24, 1), (2003, [inf, 1.0], 1), (2004, [], 1), (2005, out[0][1], None), (2006, [1.0, 2.0], 0), (2007, [2.0, 4.0], 0), (2008, [None, 1.0], 0), (None, out[4][1], 0)]


def test_vectors(spark):
    table = vector_rows()
    fine = [i for i, (_, v, g) in enumerate(table) if g is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    near = []
    for a in fine:
        for b in fine:
            va, vb = table[a][1], table[b][1]
            if a < b and table[a][2] == table[b][2] and len(va) == len(vb):
                x, y = np.array(va), np.array(vb)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    near.append((a, b))
    links = Counter(i for pair in near for i in pair)
    roots = smallest_reachable([r[0] for r in table], near)
    expected = Counter((r[0], links[i], roots[i], r[0] is not None and r[0] == roots[i]) for i, r in enumerate(table))
    frame = spark.createDataFrame([(*r, "x", 1) for r in table], "vec_id long, embedding array<float>, label int, name string, cid int").repartition(4)
    for how in (embeddings.Hashing(), embeddings.Hashing(tile=8)):
        got = Counter(tuple(r) for r in embeddings.near_duplicates(frame, how=how).collect())
        assert got == expected
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_vector_recall(spark):
    """Pairs just above the limit, where hashing misses most."""
    r = np.random.default_rng(2)
    out = []
    for i in range(400):
        a, b = r.normal(size=(2, 64))
        b -= a * (a @ b) / (a @ a)
        c = 0.98 + 0.004 * r.random()
        out += [(2 * i, a.tolist(), 0), (2 * i + 1, (c * a / np.linalg.norm(a) + np.sqrt(1 - c * c) * b / np.linalg.norm(b)).tolist(), 0)]
    got = embeddings.near_duplicates(spark.createDataFrame(out, "vec_id long, embedding array<double>, label int")).collect()
    assert sum(x["n_links"] for x in got) >= 0.97 * 800


def test_hadamard():
    x = np.random.default_rng(1).normal(size=(5, 8))
    h = np.array([[1.0]])
    for _ in range(3):
        h = np.block([[h, h], [h, -h]])
    assert np.allclose(embeddings.hadamard(x), x @ h / np.sqrt(8))


PAGE = """<!doctype html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="site-header"><a href=/>Home</a></header><nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>
<div class="cookie-notice"><p>We use cookies &amp; more.</p></div><div class=ad>Buy this now, it is very good.</div>
<article><h1>The  &eacute;vent</h1><p>First paragraph, with <b>bold</b> and a <a href=x>link</a>.<br>Same block.<p>Open &lt;paragraph&gt;&nbsp;two.
<ul><li>item one<li>item two</ul><div class="share"><a href=f>Share</a></div><form><p>Enter your mail</p><input></form><p>Last one.</p></article>
<aside class=sidebar><h3>Related</h3><a href=q>Other story of the day</a></aside>
<section class="comments"><h2>Comments</h2><p>I think this is wrong, and here is a long reason why I do.</p></section>
<footer>&copy; 2020 Someone</footer></body></html>"""


def test_page_text(spark):
    table = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", PAGE[: PAGE.index("Last one")]), (4, "u", "<p>"), (5, "u", "plain text only"), (None, "u", "<nav>a</nav>")]
    out = pages.extract(spark.createDataFrame([(*r, "x", 1) for r in table], "page_id long, url string, html string, text string, n_chars int")).collect()
    got = {(r["page_id"], r["n_chars"]): r["text"] for r in out}
    lines = ["The évent", "First paragraph, with bold and a link. Same block.", "Open <paragraph> two.", "item one", "item two", "Last one."]
    assert got[1, len("\n".join(lines))] == "\n".join(lines)
    assert got[4, len("\n".join(lines[:-1]))] == "\n".join(lines[:-1])
    assert got[2, 0] == got[3, 0] == got[None, 0] == "" and len(out) == len(table)
    assert pages.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_page_marks_and_fallbacks(spark):
    """A mark that means something else is no label, and an article's formulas and fallbacks are text of it."""
    inside = "<p>The energy is <math><mi>E</mi><mo>=</mo><mi>m</mi></math> in all of these cases.</p><noscript><p>A long chart as a table for all readers.</noscript>"
    inside += "<p>See <object data=x>the old drawing</object> and <canvas>the new drawing</canvas> of the house.</p><p>The last words of it stand here.</p>"
    page = PAGE.replace("</head>", '<script data-main="js/app" src="require.js"></script></head>').replace("<p>Last one.</p>", inside)
    marked = PAGE.replace("<header", '<header data-main="1"')
    out = pages.extract(spark.createDataFrame([(1, "u", page), (2, "u", PAGE), (3, "u", marked)], "page_id long, url string, html string")).collect()
    got = {r["page_id"]: r["text"].split("\n") for r in out}
    assert got[1][-4:] == ["The energy is E=m in all of these cases.", "A long chart as a table for all readers.", "See the old drawing and the new drawing of the house.", "The last words of it stand here."]
    assert got[3] == got[2] == [*got[1][:-4], "Last one."]


def test_pages_held_out():
    model = pages.train(labelled_pages.labelled_pages())
    trees = [pages.parse(p.encode()) for p in labelled_pages.labelled_pages(200, seed=77)]
    f = pages.features(trees)
    right = ((pages.marginals(f, model) > 0.5) == f["label"])[f["size"] > 0]
    assert right.mean() > 0.99


SOME = "The river rose in the night and the people of the lower streets carried what they could to the church on the hill"
LAYOUTS = [
    # (page, lines of its main text), written by hand
    (f"<html><body><article><p>{SOME}.</p><ul><li><a href=x>one link</a></li></ul></article></body></html>", [f"{SOME}.", "one link"]),
    ("<html><body><main id='search-results'>" + "".join(f"<p>{SOME} {i}.</p>" for i in range(10)) + "</main></body></html>", [f"{SOME} {i}." for i in range(10)]),
    (f"<html><body><h1>A flood</h1><p>{SOME}.</p><p>{SOME} again.</p></body></html>", ["A flood", f"{SOME}.", f"{SOME} again."]),
    (f"<body><div id=wrap><nav><a href=a>Home</a> <a href=b>News</a></nav><div class=post><h1>A flood</h1><p>{SOME}.</p><blockquote>{SOME}, she said.</blockquote></div><footer>Copyright by us</footer></div></body>",
     ["A flood", f"{SOME}.", f"{SOME}, she said."]),
    (f"<body><header><h1>The Paper</h1></header><section class=story><h2>A flood</h2><p>{SOME}.</p><p>Short one.</p><ol><li>First</li><li>Second</li></ol></section><div id=comments><p>{SOME}, I think.</p></div></body>",
     ["A flood", f"{SOME}.", "Short one.", "First", "Second"]),
    (f"<body><nav><ul><li><a href=a>One</a></ul></nav><p>{SOME}.</p><p>{SOME} too.</p><p>{SOME} as well.</p><div class=footer>Imprint</div></body>", [f"{SOME}.", f"{SOME} too.", f"{SOME} as well."]),
    ("<body><nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav><div class=cookie>We use cookies here</div><footer>Imprint</footer></body>", []),
    (f"<body><main><article id=has-comments><h1>A flood</h1><p>{SOME}.</p><aside class=related><a href=q>Another flood</a></aside><p>{SOME} then.</p></article></main></body>", ["A flood", f"{SOME}.", f"{SOME} then."]),
]


@pytest.mark.parametrize("page,lines", LAYOUTS)
def test_pages_of_other_layouts(page, lines):
    model = pages.train(labelled_pages.labelled_pages())
    assert pages.main_texts([pages.parse(page.encode(), labels=False)], model)[0].split("\n") == (lines or [""])


def test_broken_pages_take_linear_time():
    import time

    model = pages.train(labelled_pages.labelled_pages(60))
    start = time.process_time()
    for page in ("<b>" * 5000 + "</q>" * 20_000, "<div>" * 5000 + "x" + "</p>" * 20_000, "<i><div>" * 2000 + "</i>" * 20_000, "<p>a<li>b<td>c" * 2000, "<b>x</b>" * 20_000):
        pages.main_texts([pages.parse(page.encode(), labels=False)], model)
    assert time.process_time() - start < 15


def test_marginals_are_those_of_all_assignments():
    model = pages.train(labelled_pages.labelled_pages(60))
    tree = pages.parse(b"<body><div class=ad><p>one two</p></div><article><h1>x y</h1><p>a b c d e <a>f</a></p></article></body>")
    f = pages.features([tree])
    n, total, main = len(f["parent"]), 0.0, np.zeros(len(f["parent"]))
    for code in range(1 << n):
        y = [code >> i & 1 for i in range(n)]
        s = model["root"][y[0]] + sum(model[k][f[k][i]][y[i]] * f["block"][i] for k in pages.LEVELS for i in range(n))
        s += sum(model["edge"][f["tag"][i], f["hint"][i]][y[f["parent"][i]], y[i]] for i in range(1, n))
        total += math.exp(s)
        main += math.exp(s) * np.array(y)
    assert np.allclose(pages.marginals(f, model), main / total)


def test_pages_query(spark, small):
    html = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    import html as h
    import re

    for r in QUERIES["op8_dom_marginals"](spark, small).collect():
        part = html[r["page_id"]].split("<article>")[1].split("</article>")[0]
        lines = (" ".join(h.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?p>|</?h1>", part))
        assert r["text"] == "\n".join(x for x in lines if x) and r["n_chars"] == len(r["text"])


def test_archive_edges(spark, tmp_path):
    table = [(5, "u\r\nX: y", "same"), (3, "v%0A", "same"), (9, None, "same"), (4, "w", None), (2, "w", ""), (7, "z", "é😀\r\n\r\nWARC/1.1\r\n" * 50), (3, "v", "same"), (None, "n", "same"), (None, "n", "alone"), (8, "b", "x" * 300_000)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in table], "page_id long, url string, html string, bundle string, at int").repartition(3)
    index = warc.write(frame, folder=f"file://{tmp_path}/bundles", frame_bytes=2000, bundle_bytes=3000)
    got = warc.read(index, with_payload=True).collect()
    first = {"same": 3, "": 2}
    expected = Counter()
    for i, u, t in table:
        body = (t or "").encode()
        owner = first.get(t or "", i)
        revisit = i != owner
        expected[(i, u, "revisit" if revisit else "response", len(body), warc.base32_sha1(body), owner if revisit else None, None if revisit else body)] += 1
    names = ("page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to")
    assert Counter((*(r[c] for c in names), None if r["payload"] is None else bytes(r["payload"])) for r in got) == expected
    fetched = warc.fetch(index.filter("page_id = 7 or page_id = 9")).collect()
    assert {(r["page_id"], r["record_type"]) for r in fetched} == {(7, "response"), (9, "revisit")}
    assert len(index.collect()) == len(table)
    for path in {r["bundle"] for r in index.collect()}:  # standard tools read it: frames, then a skippable one
        data = open(path.removeprefix("file://"), "rb").read()
        assert struct.unpack("<I", data[-4:])[0] == warc.SEEKABLE
        plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert plain.startswith(warc.VERSION)
    sizes = warc.write(frame, least=10).join(index.select("page_id"), "page_id", "left_semi")
    assert Counter(r["record_type"] for r in warc.read(sizes).collect())["revisit"] == 0
    assert warc.read(warc.write(frame.limit(0))).count() == 0


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    given = {r["doc_id"]: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "SimHash near-dedup", "secret scans", "mixing sources", "SentencePiece encoding"]
    verdict = {r["doc_id"]: r["kept"] for r in quality.judge(docs, quality.references(docs)).collect()}
    good = stages["quality rules"](spark, docs, folder)
    assert {tuple(r) for r in good.collect()} == {tuple(r) for i, r in given.items() if verdict[i]}
    ids = [i for i in given if verdict[i]]
    prints = [fingerprint_by_hand(given[i]["text"]) for i in ids]
    near = [(i, j) for i in range(len(ids)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 2]
    left = set(smallest_reachable(ids, near))
    single = stages["SimHash near-dedup"](spark, good, folder)
    assert {r["doc_id"] for r in single.collect()} == left and single.count() == len(left)
    clean = stages["secret scans"](spark, single, folder)
    assert clean.schema == docs.schema
    for r in clean.collect():
        assert r["n_chars"] == len(r["text"])
        if "[SECRET]" not in r["text"]:
            assert r["text"] == given[r["doc_id"]]["text"]
    assert all(r["secret_spans"] == [] for r in secrets.scan(clean).collect())
    mix = stages["mixing sources"](spark, clean, folder)
    copies = {r["doc_id"]: len(r["positions"]) for r in mixing.mix(clean).collect()}
    assert Counter(r["doc_id"] for r in mix.collect()) == +Counter(copies) and mix.columns == docs.columns
    out = corpus_pipeline.run(spark, folder).collect()
    assert Counter(r["doc_id"] for r in out) == +Counter(copies)
