import numpy as np
import pytest

from larder.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x string, n string, dim string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "", "", "") for i, v in rows], SCHEMA)


def brute(rows, k=4):
    """{id: (n, deviation, [whitened up to sign], [explained])} from the eigenvectors of the covariance."""
    x = [(i, [int(np.floor(256.0 * float(np.float32(c)))) for c in v]) for i, v in rows]
    fit = np.array(sorted({tuple(v) for _, v in x}))
    n, total = len(fit), fit.sum(axis=0)
    mean = total / n
    cov = (fit - mean).T @ (fit - mean) / n
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:k]
    values, vectors = values[order], vectors[:, order]
    out = []
    for i, v in x:
        v = np.array(v)
        out.append((i, n, int(sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, total))), (v - mean) @ vectors / np.sqrt(values), values / np.trace(cov)))
    return out


def check(spark, rows, usable=None, k=4):
    got = whitening.whiten(table(spark, rows)).toPandas()
    want = brute(usable or rows, k)
    assert len(got) == len(want) * k and (got["identity_error"] <= 1e-9).all()
    got = got.sort_values(["vec_id", "component"], kind="stable")
    signs = None
    for i, n, dev, white, explained in sorted(want, key=lambda w: w[0]):
        mine = got[got["vec_id"] == i].iloc[:k]
        assert mine["component"].tolist() == list(range(1, k + 1))
        assert set(mine["n"]) == {n} and set(mine["deviation"]) == {dev}
        if signs is None or (np.abs(white) > 0.1).all():
            now = np.sign(mine["whitened"].to_numpy() * white)
            signs = now if signs is None else signs
            assert (now == signs).all()
        np.testing.assert_allclose(mine["whitened"], white * signs, rtol=0, atol=1e-8)
        np.testing.assert_allclose(mine["explained"], explained, rtol=1e-9)


def cloud(n, dim, seed):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, dim)) @ np.diag(0.8 ** np.arange(dim)) @ np.linalg.qr(rng.normal(size=(dim, dim)))[0] + 0.3


def test_against_eigenvectors(spark):
    check(spark, list(enumerate(cloud(400, 12, 1))))


def test_repeated_rows_count_once_in_the_fit(spark):
    x = cloud(150, 6, 2)
    check(spark, list(enumerate(np.vstack([x, np.repeat(x[3:4], 200, axis=0)]))))


def test_unusable_rows_and_clashing_columns(spark):
    x = list(enumerate(cloud(80, 5, 3)))
    bad = [(900, None), (901, [None] * 5), (902, [float("nan")] * 5), (903, [float("inf")] + [0.0] * 4), (904, [])]
    check(spark, x + bad, x)


def test_linear_dependence_and_flat_components(spark):
    x = cloud(200, 3, 4)
    wide = np.hstack([x, x[:, :2], np.ones((200, 2))])  # dependent and constant columns
    got = whitening.whiten(table(spark, list(enumerate(np.round(wide * 64) / 64)))).toPandas()
    assert sorted(set(got["component"])) == [1, 2, 3] and len(got) == 600 and got["identity_error"].max() <= 1e-8


def test_large_values_and_lengths_apart(spark):
    x = cloud(60, 4, 5)
    big = [(i, v * 1e6 + 1e7) for i, v in enumerate(x)]
    other = [(1000 + i, [float(i), float(i % 7), float(i * i % 11), i % 3.0]) for i in range(50)]
    other = [(i, v + [0.5 * (i % 5)]) for i, v in other]
    both = whitening.whiten(table(spark, big + other)).toPandas()
    apart = [whitening.whiten(table(spark, r)).toPandas() for r in (big, other)]
    for part in apart:
        mine = both[both["vec_id"].isin(part["vec_id"])].sort_values(["vec_id", "component"])
        part = part.sort_values(["vec_id", "component"])
        np.testing.assert_allclose(mine["whitened"].abs(), part["whitened"].abs(), atol=1e-6)
        assert mine["n"].tolist() == part["n"].tolist()
        assert mine["deviation"].astype(float).fillna(-1).tolist() == part["deviation"].astype(float).fillna(-1).tolist()


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 0.25])], [(1, [0.5]), (2, [0.5])], [(1, []), (2, [])]])
def test_nothing_to_whiten(spark, rows):
    assert whitening.whiten(table(spark, rows)).count() == 0


def test_null_ids_and_two_vectors(spark):
    got = whitening.whiten(table(spark, [(None, [1.0, 0.0]), (5, [0.0, 0.0]), (5, [0.0, 0.0])])).toPandas()
    assert got["vec_id"].isna().sum() == 1 and len(got) == 3 and set(got["n"]) == {2}
    assert set(got["whitened"].abs().round(9)) == {1.0} and set(got["deviation"]) == {256 * 256}


def test_deviation_beyond_a_long_is_null():
    fit = whitening.Fit(4, [0, 0])
    assert whitening.deviation(np.array([[2**31, 2**31], [1, 2]]), fit) == [None, 80]


def test_triangular_solve_and_orthogonal_rows():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(500, 10)) @ np.diag(10.0 ** -np.arange(10))  # condition of 1e9
    y, factors = x, []
    for turn in range(4):
        r = whitening.factor(y.T @ y, len(x), shifted=not turn)
        np.testing.assert_allclose(whitening.solved(y, r) @ r, y, atol=1e-12)
        y = whitening.solved(y, r)
        factors.append(r)
    assert np.abs(y.T @ y - np.eye(10)).max() < 1e-13
    product = np.linalg.multi_dot(factors[::-1])
    np.testing.assert_allclose(np.linalg.svd(product)[1], np.linalg.svd(x)[1], rtol=1e-6)
