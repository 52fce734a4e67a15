"""Line dedup where boilerplate is most of a page and where pages are copies."""

from __future__ import annotations

from caremart.llm import lines

FOOT = "All rights reserved by the publisher of this page"


def _clean(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = lines.dedup(docs, min_sites=10, min_chars=10, **more)
    assert out.columns == docs.columns
    return {r.doc_id: r.text for r in out.collect()}


def test_short_pages_lose_their_boilerplate(spark):
    rows = [(k, f"own text number {k}\n{FOOT}", f"s{k}") for k in range(12)]
    assert _clean(spark, rows) == {k: f"own text number {k}" for k in range(12)}


def test_copied_pages_lose_only_real_boilerplate(spark):
    page = [f"line {k} of a page that many sites have copied" for k in range(20)]
    rows = [(100 + k, "\n".join([*page, FOOT]), f"s{k}") for k in range(15)]
    near = [f"line {k} of another page with one word changed" for k in range(20)]
    changed = {200 + k: [*near[:k], f"{near[k]} {k}", *near[k + 1:]] for k in range(20)}
    rows += [(k, "\n".join([*x, FOOT]), f"s{k - 200}") for k, x in changed.items()]
    rows += [(k, f"own text number {k}\n{FOOT}", f"s{k}") for k in range(12)]
    got = _clean(spark, rows)
    assert all(got[100 + k] == "\n".join(page) for k in range(15))
    assert all(got[k] == "\n".join(x) for k, x in changed.items())
    assert all(got[k] == f"own text number {k}" for k in range(12))
