"""Exact search, vector codes and fill-in-the-middle against brute force."""

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemart.llm import innerproduct, vectorcodes
from tidemart.llm.fillmiddle import fill_in_middle, restore
from tidemart.llm.innerproduct import Search, principal_axes, top_products

VECTORS = "vec_id bigint, embedding array<double>, label int, score string, code int, place string"


def vectors(spark, rows, shape=VECTORS):
    """Vectors with columns whose names clash with those of the operators."""
    return spark.createDataFrame([(i, v, n, "x", 1, "y") for i, v, n in rows], shape)


def usable(rows):
    good = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    return [r for r in rows if good(r[1])]


def whole(v, factor, dims):
    return tuple(math.floor(factor * x) for x in v) + (0,) * (dims - len(v))


# Exact search ------------------------------------------------------------------------------


def brute_top(rows, k=10, factor=1024, every=100):
    rows = usable(rows)
    dims = max((len(v) for _, v, _ in rows), default=0)
    different = sorted({(i, whole(v, factor, dims)) for i, v, _ in rows}, key=lambda r: (r[0] is None, r))
    out = []
    for q in different:
        if q[0] is None or q[0] % every:
            continue
        scores = [(-sum(a * b for a, b in zip(q[1], w)), i is None, i) for i, w in different if (i, w) != q]
        limit = lambda x: max(min(x, (1 << 63) - 1), -(1 << 63))
        best = sorted((-limit(-s), none, i or 0, i) for s, none, i in scores)[:k]
        out += [(q[0], n + 1, i, limit(-s)) for n, (s, _, _, i) in enumerate(best)]
    return sorted(out, key=str)


def found_top(df, **more):
    rows = top_products(df, F.col("vec_id") % 100 == 0, **more).collect()
    return sorted((tuple(r) for r in rows), key=str)


def random_rows(n, dims, seed=0, spread=1.0):
    rng = np.random.default_rng(seed)
    scale = np.exp(spread * rng.normal(size=n))
    return [(i, (scale[i] * rng.normal(size=dims)).tolist(), i % 3) for i in range(n)]


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_search_in_waves_and_blocks(spark, monkeypatch, spread):
    monkeypatch.setattr(innerproduct, "FIRST", 30)
    monkeypatch.setattr(innerproduct, "GROWTH", 3)
    monkeypatch.setattr(innerproduct, "BLOCK_BYTES", 2 * 8 * 12)
    rows = random_rows(700, 12, spread=spread)
    assert found_top(vectors(spark, rows)) == brute_top(rows)


def test_search_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (100, [1.0, 2.0], 1), (100, [1.0, 2.0], 1), (100, [3.0], 2), (200, [], 1),
        (1, None, 1), (2, [nan, 1.0], 1), (3, [inf, 1.0], 1), (4, [None, 1.0], 1), (300, [-inf], 1),
        (None, [1.0, 2.0], None), (5, [0.0, 0.0], 1), (400, [-1.0, -0.0001], 1), (500, [1e-5, 5.0], 1),
    ] + [(600 + i, [2.0, -1.0], 1) for i in range(40)]
    assert found_top(vectors(spark, rows)) == brute_top(rows)
    assert found_top(vectors(spark, rows), k=2) == brute_top(rows, k=2)


def test_search_of_great_numbers_is_exact_or_stops_at_64_bits(spark):
    rows = [(i, [x, 1.0 / (i + 1)], 0) for i, x in enumerate([1e4, -3e7, 2e11, 5e14, -5e14])]
    rows = [(100 * i, v, n) for i, v, n in rows]
    assert found_top(vectors(spark, rows)) == brute_top(rows)


def test_search_of_empty_tables(spark):
    assert found_top(vectors(spark, [])) == []
    assert found_top(vectors(spark, [(1, [1.0], 1)])) == []  # no query
    assert found_top(vectors(spark, [(100, [1.0], 1)])) == []  # nothing but the query
    assert found_top(vectors(spark, [(100, None, 1)])) == []


def test_a_vector_of_very_many_rows(spark):
    rows = [(i, [1.0, 0.5, 0.25], 0) for i in range(500)] + [(1000 + i, [2.0, 0.0, i / 50], 0) for i in range(50)]
    assert found_top(vectors(spark, rows)) == brute_top(rows)


def test_bounds_prune_and_lose_nothing(monkeypatch):
    """Tiles of all kinds: pruned by length, by bound, multiplied pair by pair and whole."""
    monkeypatch.setattr(innerproduct, "LANE", 7)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(2000, 16)) * (0.8 ** np.arange(16))
    base *= 1000 / np.linalg.norm(base, axis=1)[:, None]
    rows = np.floor(base * np.exp(0.05 * rng.normal(size=(2000, 1)))).astype(np.int64)
    rows = rows[np.argsort(-np.linalg.norm(rows.astype(float), axis=1))]
    queries = rows[::100]
    search = Search(queries, np.full(len(queries), -(1 << 63)), principal_axes(rows[:500]), 5)
    multiplied = []
    plain = innerproduct.pair_products
    monkeypatch.setattr(innerproduct, "pair_products", lambda a, b, t: multiplied.append(len(a)) or plain(a, b, t))
    for low in range(0, len(rows), 250):
        search.offer(rows[low : low + 250], np.arange(low, min(low + 250, len(rows))))
    got = np.concatenate(search.found)
    scores = queries @ rows.T
    for q in range(len(queries)):
        order = np.lexsort((np.arange(len(rows)), -scores[q]))[:5]
        assert got[got[:, 0] == q][:, 2].tolist() == order.tolist()
        assert got[got[:, 0] == q][:, 1].tolist() == scores[q][order].tolist()
    assert 0 < sum(multiplied) < 0.1 * scores.size


# Vector codes ------------------------------------------------------------------------------


def brute_codes(rows, parts=8, entries=16, rounds=6, factor=4096):
    rows = usable(rows)
    size = max((len(v) for _, v, _ in rows), default=0)
    dims = -(-size // parts) * parts
    width = dims // parts
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[whole(v, factor, dims)[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in rows]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]
    far = lambda x, e: sum((a - b) ** 2 for a, b in zip(x, e))
    nearest = lambda x, p: min((far(x, e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(c[p], p)[1], []).append(c[p])
            for k, found in groups.items():
                books[p][k] = [sum(col) // len(found) for col in zip(*found)]
    out = []
    for (i, _, label), c in zip(rows, cut):
        best = [nearest(c[p], p) for p in range(parts)]
        out.append((i, label, [k for _, k in best], min(sum(d for d, _ in best), (1 << 63) - 1)))
    return sorted(out, key=str), [[[int(x) for x in e] for e in b] for b in books]


def found_codes(df, **more):
    coded, books = vectorcodes.compress(df, **more)
    rows = [(r["vec_id"], r["label"], list(r["code"]), r["error"]) for r in coded.collect()]
    return sorted(rows, key=str), [[[int(x) for x in e] for e in b] for b in books]


@pytest.mark.parametrize("dims,parts", [(16, 8), (11, 4), (3, 8)])
def test_codes_follow_the_rounds(spark, dims, parts):
    rows = random_rows(300, dims, seed=dims)
    assert found_codes(vectors(spark, rows), parts=parts) == brute_codes(rows, parts=parts)


def test_codes_of_odd_rows(spark):
    nan = float("nan")
    rows = [
        (9, [1.0, 2.0, 3.0], None), (9, [1.0, 2.0, 3.0], None), (None, [0.5], 2), (7, [], 2), (6, None, 2),
        (5, [nan], 2), (4, [None], 1), (3, [float("inf")], 1), (2, [-0.0001, 0.0, 1.0], 1), (2, [0.0001, 0.0], 1),
    ]
    assert found_codes(vectors(spark, rows), parts=2, entries=3) == brute_codes(rows, parts=2, entries=3)
    few = [(1, [1.0, 0.0], 0), (2, [0.0, 1.0], 0)]  # fewer vectors than entries
    assert found_codes(vectors(spark, few)) == brute_codes(few)
    assert found_codes(vectors(spark, []))[0] == []
    assert found_codes(vectors(spark, [(1, None, 1)]))[0] == []


def test_codes_of_great_numbers(spark):
    rows = [(i, [x, -x / 3], i) for i, x in enumerate([1e3, 1e9, -4e11, 7e13, 3.0, 2e12, 0.0])]
    assert found_codes(vectors(spark, rows), parts=2, entries=2) == brute_codes(rows, parts=2, entries=2)


def test_label_errors(spark):
    shape = "vec_id bigint, label int, code array<int>, error bigint"
    rows = [(1, None, [0], 5), (2, None, [0], 6), (3, 1, [0], 1 << 62), (4, 1, [1], 1 << 62), (5, 2, [1], 0)]
    got = vectorcodes.with_label_error(spark.createDataFrame(rows, shape)).collect()
    expected = {1: 11, 2: 11, 3: (1 << 63) - 1, 4: (1 << 63) - 1, 5: 0}
    assert {r["vec_id"]: r["label_error"] for r in got} == expected
    assert vectorcodes.with_label_error(spark.createDataFrame([], shape)).collect() == []


# Fill in the middle ------------------------------------------------------------------------

DOCS = "doc_id bigint, text string, n string, form int, output string, row int, t string, h1 int"


def brute_middle(doc_id, text, unit=r"[^\n]*\n|[^\n]+", rate=100, spm_rate=50):
    text = text or ""
    units = [m[0] for m in re.finditer(unit, text, re.S)]
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", text, None, None
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_rate:
        return len(units), "spm", f"<S>{suf}<P>{pre}<M>{mid}", len(pre), len(mid)
    return len(units), "psm", f"<P>{pre}<S>{suf}<M>{mid}", len(pre), len(mid)


TEXTS = [
    None, "", "\n", "a", "a\n", "a\nb", "\n\n\n", "x\r\ny\r\n", "é\n𝄞 clef\n語\n" * 5, "$1 \\ (a|b)*\n" * 9,
    "has <P> in it\nb", "ends <S", "S>starts\n<\n<M\nM>", "<M>", "tab\tnul\x00\n\x0b\x0c\n \n\x85\n",
    "a\n" * 200_000, "z" * 1_000_000, "long line " * 100_000 + "\n" + "tail",
]


@pytest.mark.parametrize("more", [{}, {"rate": 60, "spm_rate": 10}, {"unit": "(?s)."}])
def test_middles_follow_the_draws(spark, more):
    ids = [None, *range(1, 3 * len(TEXTS))]
    texts = [TEXTS[k % len(TEXTS)] for k in range(len(ids))]
    if "unit" in more:
        texts = [t and t[:300] for t in texts]
    docs = spark.createDataFrame([(i, t, "n", 1, "o", 2, "t", 3) for i, t in zip(ids, texts)], DOCS)
    moved = fill_in_middle(docs, **more).withColumn("back", restore(F.col("output"), F.col("form")))
    assert {"row", "t", "h1", "text"} <= set(moved.columns)
    by_id = dict(zip(ids, texts))
    rows = moved.collect()
    assert len(rows) == len(ids)
    for r in rows:
        got = (r["n"], r["form"], r["output"], r["prefix_chars"], r["middle_chars"])
        assert got == brute_middle(r["doc_id"], by_id[r["doc_id"]], **more)
        assert r["back"] == (by_id[r["doc_id"]] or "") and r["row"] == 2 and r["h1"] == 3
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}


def test_middles_of_repeated_rows_and_an_empty_table(spark):
    docs = spark.createDataFrame([(5, "a\nb\nc\n")] * 3 + [(5, "other")], "doc_id bigint, text string")
    rows = fill_in_middle(docs).collect()
    assert len(rows) == 4 and len({r["output"] for r in rows}) == 2
    assert fill_in_middle(docs.limit(0)).collect() == []


def test_middles_need_no_shuffle_and_no_python(spark):
    docs = spark.createDataFrame([(5, "a\nb\n")], "doc_id bigint, text string")
    plan = fill_in_middle(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Arrow" not in plan and "Python" not in plan
