"""Operators on tables in which one group holds a third of the rows."""

from __future__ import annotations

import numpy as np
import pytest

from caremart.llm import minhash, pivots


def _links(x, threshold):
    """Links by brute force: how many other vectors lie within the threshold of each."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    return np.concatenate([(unit[k:k + 2000] @ unit.T >= threshold).sum(axis=1) - 1 for k in range(0, len(x), 2000)])


def _vectors(spark, x):
    rows = [(k, v, 0) for k, v in enumerate(x.tolist())]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


@pytest.mark.parametrize("dim", [64, 128])
def test_links_of_a_hot_group_of_unequal_near_copies(spark, dim):
    """20,000 rows, a third of them around one vector at a cosine of about 0.98 to each other, the others in groups of three."""
    n, rng = 20_000, np.random.default_rng(dim)
    hot = n // 3
    centre = np.concatenate([np.repeat(rng.standard_normal((1, dim)), hot, axis=0),
                             np.repeat(rng.standard_normal((n // 3 + 1, dim)), 3, axis=0)[:n - hot]])
    x = centre + rng.standard_normal((n, dim)) * 0.14
    want = _links(x, 0.98)
    out = pivots.near_duplicates(_vectors(spark, x)).select("vec_id", "n_links").toPandas().sort_values("vec_id")
    got = out["n_links"].to_numpy()
    assert (got <= want).all()
    recall = {"hot": got[:hot].sum() / want[:hot].sum(), "small": got[hot:].sum() / want[hot:].sum()}
    print(f"dim {dim}: {want[:hot].sum() // 2} links in the hot group; recall", recall)
    assert recall["hot"] >= 0.99 and recall["small"] >= 0.97


@pytest.mark.parametrize("near", [1, 3])
def test_tables_that_are_near_copies_throughout(spark, near):
    rng = np.random.default_rng(near)
    x = np.repeat(rng.standard_normal((near, 16)) * 3, 30, axis=0) + rng.standard_normal((30 * near, 16)) * 0.1
    want = _links(x, 0.98)
    got = pivots.near_duplicates(_vectors(spark, x)).toPandas().sort_values("vec_id")["n_links"].to_numpy()
    assert want.min() > 0 and (got == want).all()


@pytest.mark.parametrize("n", [3_000, 12_000])
def test_equal_vectors_are_one_class(spark, n):
    """A third of the rows holds one vector, a third small groups of copies; one near copy of the large group."""
    rng = np.random.default_rng(n)
    x = np.concatenate([np.repeat(rng.standard_normal((1, 16)), n // 3, axis=0), np.repeat(rng.standard_normal((n // 12, 16)), 4, axis=0),
                        rng.standard_normal((n // 3, 16))])
    x[-1] = x[0] + 1e-3
    order = rng.permutation(n)
    want = _links(x[order], 0.98)
    out = pivots.near_duplicates(_vectors(spark, x[order])).toPandas().sort_values("vec_id")
    got = out["n_links"].to_numpy()
    assert (got <= want).all() and got.sum() >= 0.99 * want.sum()
    hot = np.flatnonzero((order < n // 3) | (order == n - 1))
    assert (got[hot] == want[hot]).all() and (out["component_id"].to_numpy()[hot] == hot.min()).all()
    assert out["kept"].to_numpy()[hot].sum() == 1


def _components(sets, percent):
    """The smallest id that links reach, by brute force."""
    of = dict.fromkeys(sets)
    for start in sorted(sets):
        if of[start] is None:
            of[start], todo = start, [start]
            while todo:
                a = todo.pop()
                near = [b for b in sets if of[b] is None and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
                of.update(dict.fromkeys(near, start))
                todo += near
    return of


@pytest.mark.parametrize("block", [16, 1024])
def test_large_bands_with_several_components(spark, monkeypatch, block):
    """250 variants of a text around the threshold, some far off, and a third of all rows equal."""
    monkeypatch.setattr(minhash, "SMALL", 2)
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for k in range(250):
        own = list(base)
        for at in rng.choice(120, int(rng.integers(0, 9)), replace=False):
            own[at] = f"x{k}y{at}"
        texts.append(" ".join(own))
    texts += [" ".join(base)] * 125
    ids = rng.permutation(len(texts)).tolist()
    sets = {i: {tuple(t.split()[k:k + 4]) for k in range(117)} for i, t in zip(ids, texts, strict=True)}
    want = _components(sets, 80)
    assert 2 < len(set(want.values())) < 250
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, words=4, percent=80).collect()}
    assert got == want
