"""Whitening, exact search and codes against plain versions."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemart.llm import codes, search, whitening
from tidemart.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, key string, x int, uid string, n int, row int, code string, score int"


def vector_rows(seed=3, width=24):
    """Vectors with all awkward rows: nulls, other lengths, copies, ties, repeated and null ids."""
    r = random.Random(seed)
    base = [[r.gauss(0, 1 + (i % 5)) / 8 for i in range(width)] for _ in range(150)]
    some = base + [base[5]] * 60 + [[0.0] * width, None, [], [float("nan")] * width, [float("inf")] + base[0][1:], base[0][:-1] + [None]]
    some += [base[1][:6], base[2][:6], base[3][:6], [1.5], [-0.0] * width]
    rows = [(i, v, [None, 0, 1][i % 3]) for i, v in enumerate(some)]
    rows += [(40, base[7], 1), (40, base[5], 1), (None, base[9], None), (None, None, None), (-20, base[5], 2), rows[0]]
    return [(*row, "k", 1, "u", 2, 3, "c", 4) for row in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(vector_rows(), SCHEMA).repartition(3)


def usable(rows, scale):
    """(id, label, whole numbers) of the vectors that take part; floats as the table has them."""
    out = []
    for row in rows:
        vec_id, v, label = row[:3]
        if v and all(c is not None and math.isfinite(c) for c in v):
            out.append((vec_id, label, tuple(math.floor(float(np.float32(c)) * scale) for c in v)))
    return out


def table_rows(spark, folder):
    return [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]


# ---- whitening


def check_whitened(found, rows, k=4):
    by_width = defaultdict(list)
    for vec_id, _, x in usable(rows, 256):
        by_width[len(x)].append((vec_id, x))
    assert len(found) == sum(min(k, width) * len(own) for width, own in by_width.items())
    by_n = {}
    for width, own in by_width.items():
        fit = np.array(sorted({x for _, x in own}))
        n, total = len(fit), fit.sum(axis=0)
        y = fit - total / n
        e, u = np.linalg.eigh(y.T @ y / n)
        by_n[n, width] = (own, total, e[::-1], u[:, ::-1])
    got = defaultdict(list)
    for r in found:
        got[r["vec_id"], r["n"], r["deviation"], r["component"]].append(r)
    for (n, width), (own, total, e, u) in by_n.items():
        signs = {}
        for vec_id, x in own:
            deviation = sum((n * a - int(t)) ** 2 for a, t in zip(x, total))
            for c in range(min(k, width)):
                for r in got[vec_id, n, deviation, c + 1]:
                    if e[c] <= 1e-9 * max(e[0], 1e-300):
                        assert r["whitened"] is None
                        continue
                    assert math.isclose(r["explained"], e[c] / e.sum(), rel_tol=1e-9) and r["identity_error"] < 1e-9
                    if n > width:  # fewer vectors than entries leave ties to rounding only
                        wanted = (np.array(x) - total / n) @ u[:, c] / math.sqrt(e[c])
                        if abs(wanted) > 1e-3:
                            sign = signs.setdefault(c, math.copysign(1, wanted * r["whitened"]))
                            assert math.isclose(r["whitened"], sign * wanted, rel_tol=1e-6)
            assert got[vec_id, n, deviation, 1]


def test_whitening_edges(spark, odd):
    found = whitening.whiten(odd)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitened(found.collect(), vector_rows())
    assert whitening.whiten(odd.limit(0)).collect() == []
    assert whitening.whiten(odd.filter("embedding IS NULL")).collect() == []
    same = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], "vec_id long, embedding array<double>")).collect()
    assert [(r.whitened, r.explained, r.deviation, r.n) for r in same] == [(None, None, 0, 1)] * 4
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0])], "vec_id long, embedding array<double>")
    assert {r.deviation for r in whitening.whiten(huge).collect()} == {None}


def test_whitening_query(spark, small):
    check_whitened([r.asDict() for r in QUERIES["op11_feast_whitening"](spark, small).collect()], table_rows(spark, small))


@pytest.mark.parametrize("values", [
    [9, 7, 5, 3, 1], [4, 4, 4, 1, 1, 0], [1] * 6, [1e6, 1e-3, 1e-4], [3, 2.9999, 2.9998, 2, 2, 2, 1e-9, 0, 0], [0, 0, 0], [5], list(range(40, 0, -1)),
])
def test_leading_components(values):
    d = len(values)
    turn = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))[0]
    v = turn @ np.diag(np.array(values, float)) @ turn.T
    v = (v + v.T) / 2
    for shift in (min(values) - 1, max(values) + 1, (max(values) + min(values)) / 2 + 1e-7):
        assert whitening.eigenvalues_above(v, shift) == (np.array(values) > shift).sum()
    for k in (1, 4, d):
        rank = sum(x > 1e-12 * max(values) for x in values)
        e, u = whitening.leading(v, k)
        assert len(e) == min(k, rank) and np.allclose(e, values[: len(e)], rtol=1e-9, atol=1e-12 * max(values))
        assert np.abs(u.T @ u - np.eye(len(e))).max(initial=0) < 1e-9 and np.abs(v @ u - u * e).max(initial=0) < 1e-12 * max(values[0], 1)


def test_eigenvalues_left_out_are_noticed(monkeypatch):
    v = np.diag([3.0, 2.0, 1.0])
    monkeypatch.setattr(whitening, "intervals", lambda *_: [(0.5, 4.0, 2)])
    with pytest.raises(ArithmeticError):
        whitening.leading(v, 2)


# ---- search


def best_by_hand(rows, scale, k, asked):
    own = [(i, vec_id, x) for i, (vec_id, _, x) in enumerate(usable(rows, scale))]
    out = []
    for i, query, q in own:
        if query is None or not asked(query):
            continue
        near = [(-sum(a * b for a, b in zip(q, x)), vec_id is None, vec_id or 0, vec_id) for j, vec_id, x in own if i != j and len(x) == len(q)]
        out += [(query, rank + 1, vec_id, -s) for rank, (s, _, _, vec_id) in enumerate(sorted(near, key=lambda t: t[:3])[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("how", [search.BLOCKS, search.Blocks(queries=30, numbers=900, least=40, tasks=3, columns=5, bins=16)])
@pytest.mark.parametrize("k", [1, 20])
def test_search_edges(spark, odd, how, k):
    found = search.top_k(odd, F.col("id") % 20 == 0, k, how=how)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == best_by_hand(vector_rows(), 64, k, lambda i: i % 20 == 0)


def test_search_few_rows(spark, odd):
    everybody = F.lit(True)
    assert search.top_k(odd.limit(0), everybody).collect() == []
    one = spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<double>")
    assert search.top_k(one, everybody).collect() == []
    assert search.top_k(odd, F.lit(False)).collect() == []
    large = [(i, [s * 1e12, 3e9 + i, float(i)]) for i, s in enumerate((1, -1, 1, 0))] + [(9, [1e300, -1e300, 1e300])]
    found = search.top_k(spark.createDataFrame(large, "vec_id long, embedding array<double>"), everybody, 2).collect()
    exact = [(i, [min(max(math.floor(64 * c), -(1 << 63)), (1 << 63) - 1) for c in v]) for i, v in large]
    clip = lambda s: min(max(s, -search.FAR), search.FAR)
    for i, q in exact:
        wanted = sorted((-clip(sum(a * b for a, b in zip(q, x))), j) for j, x in exact if i != j)[:2]
        assert [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == i] == [(j, -s) for s, j in wanted]


def test_search_query(spark, small):
    found = sorted(map(tuple, QUERIES["op12_histogram_top_k"](spark, small).collect()), key=str)
    assert found == best_by_hand(table_rows(spark, small), 64, 20, lambda i: i % 20 == 0)


# ---- codes


def codes_by_hand(rows, parts=8, entries=16, rounds=6):
    by_width = defaultdict(list)
    for vec_id, label, x in usable(rows, 4096):
        x += (0,) * (-len(x) % parts)
        own = len(x) // parts
        by_width[own].append((vec_id, label, [x[p * own : (p + 1) * own] for p in range(parts)]))
    out = []
    for own in by_width.values():
        first = sorted(own, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
        books = [[r[2][p] for r in first] for p in range(parts)]

        def assign(v, p):
            return min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(books[p]))

        for _ in range(rounds):
            groups = defaultdict(list)
            for r in own:
                for p in range(parts):
                    groups[p, assign(r[2][p], p)[1]].append(r[2][p])
            for (p, i), members in groups.items():
                books[p][i] = tuple(sum(column) // len(members) for column in zip(*members))
        sha = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
        for vec_id, label, v in own:
            found = [assign(v[p], p) for p in range(parts)]
            out.append((vec_id, "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found), label, sha))
    total = defaultdict(int)
    for r in out:
        total[r[3]] += r[2]
    return sorted(((i, code, error, total[label], sha) for i, code, error, label, sha in out), key=str)


@pytest.mark.parametrize("how", [codes.CODING, codes.Coding(cells=3, rows=10)])
def test_codes_edges(spark, odd, how):
    # lengths 1 and 6 have parts of one place each, so only one of them is in the plain version's groups
    rows = [r for r in vector_rows() if r[1] is None or len(r[1]) != 1]
    found = codes.compress(odd.filter("embedding IS NULL OR size(embedding) != 1"), how=how)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == codes_by_hand(rows)


def test_codes_few_rows(spark, odd):
    assert codes.compress(odd.limit(0)).collect() == []
    one = codes.compress(odd.filter("vec_id = 3")).collect()
    assert [(r.code, r.error, r.label_error) for r in one] == [("00" * 8, 0, 0)]
    huge = [(i, [s * 1e300, 1.0], 0) for i, s in enumerate([1, -1, 1] + [0.5e-300] * 20)]
    found = codes.compress(spark.createDataFrame(huge, "vec_id long, embedding array<double>, label int")).collect()
    wide = [r for r in found if r.vec_id < 3]
    assert [r.code[:2] for r in sorted(wide)] == ["00", "01", "00"] and all(r.error == 0 for r in wide)


def test_codes_query(spark, small):
    found = sorted(map(tuple, QUERIES["op13_cell_codes"](spark, small).collect()), key=str)
    assert found == codes_by_hand(table_rows(spark, small))


def test_grid_gives_the_nearest():
    r = np.random.default_rng(1)
    book, parts = r.integers(-900, 900, (16, 8)), r.integers(-1000, 1000, (500, 8))
    parts[::7] = parts[0]
    grid = codes.Grid(book, codes.CODING)
    entry, far = grid.nearest(parts)
    every = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
    assert (entry == every.argmin(axis=1)).all() and (far == every.min(axis=1)).all()
    assert sum(m.bit_count() for m in grid.masks.values()) < 16 * len(grid.masks)
