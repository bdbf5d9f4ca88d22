"""Products by tiles, nulls, spectra and exact covers against plain forms."""

import datetime
import itertools
from decimal import Decimal

import numpy as np
import pytest

from bellwether.operators import cover, gram, model

DAY = datetime.date(2020, 1, 1)


def rows_of(spark, x, value="e", skip=()):
    return spark.createDataFrame([(f"T{j:02d}", DAY + datetime.timedelta(7 * t), float(x[t, j])) for t in range(x.shape[0]) for j in range(x.shape[1]) if (t, j) not in skip], f"ticker string, bar_date date, {value} double")


def panel(t=60, n=11, seed=1):
    x = np.random.default_rng(seed).normal(size=(t, n))
    x[:, 1] = x[:, 0] + 0.1 * x[:, 1]
    x[:, 2] = 0.3
    return x


@pytest.mark.parametrize(("tile", "days"), [(64, 4096), (3, 100), (1, 30)])
def test_pair_sums_over_tiles_and_blocks(spark, tile, days):
    x = panel()
    got = gram.pair_sums(gram.series(rows_of(spark, x), "e", days), gram.products, ["s"], tile).collect()
    want = x.T @ x
    assert len(got) == 11 * 12 // 2
    assert all(r["i"] <= r["j"] and r["s"] == pytest.approx(want[int(r["i"][1:]), int(r["j"][1:])]) for r in got)


def test_rho2_has_no_join_on_sessions(spark, capsys):
    x = panel()
    p = model.rho2(rows_of(spark, x))
    got = {(r["i"], r["j"]): float(r["p"]) for r in p.collect()}
    with np.errstate(invalid="ignore"):
        want = np.nan_to_num(np.corrcoef(x.T)) ** 2
    np.fill_diagonal(want, 1)
    want[2, :2] = want[:2, 2] = want[2, 3:] = want[3:, 2] = 0
    assert all(v == pytest.approx(want[int(i[1:]), int(j[1:])], abs=1e-9) for (i, j), v in got.items()) and len(got) == 121
    p.explain()
    assert not any("Join" in line and "bar_date" in line for line in capsys.readouterr().out.splitlines())


def test_masked_pairs(spark):
    x = panel() + 50  # far from zero
    flagged = {(t, j) for t in range(60) for j in range(11) if (t * 7 + j * 3) % 5 == 0} | {(t, 9) for t in range(58)}
    flags = spark.createDataFrame([(f"T{j:02d}", DAY + datetime.timedelta(7 * t), True) for t, j in flagged], "ticker string, bar_date date, flagged boolean")
    got = {(r["i"], r["j"]): (r["t"], r["p"]) for r in model.masked_rho2(rows_of(spark, x), flags).collect()}
    seen = 0
    for a, b in itertools.combinations(range(11), 2):
        both = [t for t in range(60) if (t, a) not in flagged and (t, b) not in flagged]
        if len(both) < 3:
            assert (f"T{a:02d}", f"T{b:02d}") not in got
            continue
        u, v = x[both, a], x[both, b]
        want = 0 if np.var(u) < 1e-20 or np.var(v) < 1e-20 else np.corrcoef(u, v)[0, 1] ** 2
        assert got[f"T{a:02d}", f"T{b:02d}"] == (len(both), pytest.approx(want, abs=1e-9))
        seen += 1
    assert seen > 30


def plain_dcor2(u, v):
    a, b = (np.abs(y[:, None] - y[None, :]) for y in (u, v))
    a, b = (m - m.mean(0) - m.mean(1)[:, None] + m.mean() for m in (a, b))
    scale = np.sqrt((a * a).sum() * (b * b).sum())
    return (a * b).sum() / scale if scale > 0 else 0


@pytest.mark.parametrize(("measure", "tile", "per_task"), [("rho2", 4, 5), ("dcor2", 64, 32), ("dcor2", 3, 7)])
def test_nulls_over_tiles(spark, measure, tile, per_task):
    x = panel(t=24, n=7, seed=4)
    got = gram.permutation_null(rows_of(spark, x), 2, 20, seed=3, measure=measure, per_task=per_task, tile=tile).first()
    pooled = []
    for i in range(20):
        rng = np.random.default_rng([3, i])
        y = [rng.permutation(x[:, j]) for j in range(7)]
        p = np.eye(7)
        for a, b in itertools.combinations(range(7), 2):
            flat = np.ptp(y[a]) < 1e-12 or np.ptp(y[b]) < 1e-12
            p[a, b] = p[b, a] = plain_dcor2(y[a], y[b]) if measure == "dcor2" else 0 if flat else np.corrcoef(y[a], y[b])[0, 1] ** 2
        c, chosen = np.zeros(7), []
        for _ in range(2):
            gains = [sum(max(0, p[a, b] - c[a]) for a in range(7)) if b not in chosen else -1 for b in range(7)]
            chosen.append(int(np.argmax(gains)))
            c = np.maximum(c, p[:, chosen[-1]])
        pooled += [c[a] for a in range(7) if a not in chosen]
    assert got["n"] == len(pooled) == 100
    assert [got[q] for q in ("p50", "p95", "p99")] == pytest.approx(list(np.percentile(pooled, [50, 95, 99])))


def test_null_of_nothing(spark):
    empty = spark.createDataFrame([], "ticker string, bar_date date, e double")
    assert gram.permutation_null(empty, 2, 10).first()["n"] == 0


@pytest.mark.parametrize("parts", [1, 30])
def test_singular_values_by_a_tree_of_triangles(spark, parts):
    x = np.random.default_rng(2).normal(size=(200, 6))
    rows = spark.createDataFrame([(row.tolist(),) for row in x], "v array<double>").repartition(parts)
    got = [r["value"] for r in gram.singular_values(rows, 6).orderBy("rank").collect()]
    assert got == pytest.approx(list(np.linalg.svd(x, compute_uv=False)))


def test_spectra_of_returns_and_residuals(spark):
    rng = np.random.default_rng(3)
    f = rng.normal(size=80)
    x = rng.normal(size=(80, 9)) + np.outer(f, np.linspace(1, 2, 9))
    e = x - np.outer(f, f @ x / (f @ f))
    got = {r["matrix"]: r for r in gram.spectra({"x": (rows_of(spark, x, "x"), "x"), "e": (rows_of(spark, e), "e")}).collect()}
    edge = (1 + np.sqrt(9 / 80)) ** 2
    for name, m in (("x", x), ("e", e)):
        every = np.sort(np.linalg.eigvalsh(np.corrcoef(m.T)))[::-1]
        want = [v for v in every if v > edge]
        r = got[name]
        assert r["above"] == pytest.approx(want) and r["n_above"] == len(want) and r["n_values"] == 9
        assert r["largest"] == pytest.approx(every[0]) and r["share"] == pytest.approx(sum(want) / 9)
    assert got["x"]["n_above"] == 1


def similarity(spark, n, seed, blocks=0, decimals=18):
    rng = np.random.default_rng(seed)
    p = rng.uniform(0, 1, size=(n, n)).round(6 if decimals == 18 else decimals)
    p = np.minimum(p, p.T)
    np.fill_diagonal(p, 1)
    cells = {(i, j): Decimal(repr(float(p[i, j]))) for i in range(n) for j in range(n)}
    table = spark.createDataFrame([(f"T{i:02d}", f"T{j:02d}", v) for (i, j), v in cells.items()], "i string, j string, p decimal(20,18)")
    return table, cells


def enumerated(cells, n, k):
    value = lambda s: sum(max(cells[i, j] for j in s) for i in range(n))
    return min((-value(s), s) for s in itertools.combinations(range(n), k))


@pytest.mark.parametrize(("n", "k", "decimals"), [(9, 1, 18), (10, 2, 18), (12, 3, 18), (13, 4, 18), (12, 5, 18), (11, 4, 1), (10, 5, 0), (5, 5, 18), (6, 6, 18)])
def test_cover_equals_full_enumeration(spark, n, k, decimals):
    p, cells = similarity(spark, n, n * k, decimals=decimals)
    got = cover.exact_cover(p, k).first()
    f, subset = enumerated(cells, n, k)
    assert tuple(got[f"j{m}"] for m in range(1, k + 1)) == tuple(f"T{j:02d}" for j in subset) and got["f"] == -f


def test_cover_opens_few_prefixes():
    rng = np.random.default_rng(7)
    factors = rng.normal(size=(40, 6))
    z = factors @ factors.T
    d = np.sqrt(np.diag(z))
    units = ((z / np.outer(d, d)) ** 2 * cover.UNITS).astype(np.int64)
    start = cover.greedy_subset(units, 4)
    search = cover.Search(units, 4, (cover.exact(units, start), start))
    search.below((), np.zeros(40))
    assert search.opened < 9880 / 4  # of all triples
    best = max((units[:, list(s)].max(axis=1) / cover.UNITS).sum() for s in itertools.combinations(range(40), 4))
    assert search.best[0] / cover.UNITS == pytest.approx(best)


def test_cover_of_too_few_tickers(spark):
    p, _ = similarity(spark, 3, 1)
    assert cover.exact_cover(p, 4).count() == 0
