"""The dealt operators on small tables with nulls, empty texts, repeated rows, ties, no rows and clashing columns."""

from __future__ import annotations

import hashlib
import re
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from caremart.llm import chunks, language, lines, minhash, mixing, packing, pivots, suffixes, topk, toxicity
from caremart.llm.registry import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, kept boolean, id long, row string, band int"
LONG = " ".join(f"word{k % 97}x{k % 89}" for k in range(6000))


def _row(doc_id, text, lang="en", source="s0"):
    return (doc_id, text, lang, source, None, 7, "r", 1)


@pytest.fixture(scope="module")
def docs(spark):
    page = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    rows = [
        _row(1, page), _row(2, page), _row(2, page), _row(3, page + " omega"), _row(4, None, None, None), _row(5, ""),
        _row(6, LONG), _row(7, LONG + " end"), _row(None, page), _row(8, "été ñandú 日本\nline of boilerplate here"), _row(9, " \t\n"),
    ] + [_row(20 + k, f"own text number {k}\nline of boilerplate here", source=f"s{k}") for k in range(12)]
    return spark.createDataFrame(rows, SCHEMA)


def _plain(df):
    return df.select("doc_id", "text").distinct().collect()


def test_lines(docs):
    out = lines.dedup(docs, min_sites=10, min_chars=10, suspect_share=0.9)
    assert out.columns == docs.columns and out.count() == docs.count()
    got = {r.doc_id: r.text for r in out.where("doc_id >= 20").collect()}
    assert got == {20 + k: f"own text number {k}" for k in range(12)}
    assert lines.dedup(docs.limit(0)).count() == 0


def test_chunks_round_trip(docs):
    for r in chunks.dedup(docs).collect():
        assert r.n_removed == sum(s["end"] - s["start"] for s in r.spans) and r.n_spans == len(r.spans)
        assert (r.text is None) == (r.n_bytes == 0 and r.doc_id == 4)
        assert len((r.text or "").encode()) == r.n_bytes - r.n_removed
    kept = {r.doc_id: r for r in chunks.dedup(docs).collect()}
    assert kept[6].n_removed < 0.9 * kept[6].n_bytes and kept[7].n_removed > 0.9 * kept[7].n_bytes
    assert chunks.dedup(docs.limit(0)).count() == 0


def test_mixing(docs):
    once = mixing.mixed(docs)
    assert once.columns == docs.columns
    assert once.select("doc_id", "text").distinct().count() == docs.select("doc_id", "text").distinct().count()
    assert once.groupBy("doc_id", "text").count().agg(F.max("count")).first()[0] <= 4
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_top_k_ties_and_unusable(spark):
    vectors = spark.createDataFrame(
        [(0, [0.5, 0.25]), (3, [0.5, 0.0]), (1, [0.5, 0.0]), (2, [0.5, 0.0]), (4, None), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (3, [0.5, 0.0]),
         (None, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.search(vectors, F.col("id") % 50 == 0, k=2).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 128 * 128), (0, 2, 2, 128 * 128)]
    assert topk.search(vectors.limit(0), F.lit(True)).count() == 0


def test_packing_equals_the_tokenizer(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces = packing.pack(docs, tokenizer_path(), 1, 64).toPandas()
    want = sorted(tuple(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]) for r in docs.collect())
    assert pieces["length"].sum() == sum(map(len, want))
    ends = pieces.assign(end=pieces["offset"] + pieces["length"]).groupby("sequence_id")["end"].max()
    assert set(ends) <= {1, 2, 4, 8, 16, 32, 64}
    six = pieces[pieces["doc_id"] == 6].sort_values("start")
    ids = np.concatenate([np.frombuffer(x, "<u4") for x in six["ids"]])
    assert ids.tolist() == [*tokenizer.encode(LONG, add_special_tokens=False).ids, 1]
    assert packing.pack(docs.limit(0), tokenizer_path()).count() == 0


def test_hilbert_neighbours_touch():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    path = grid[np.argsort(packing.hilbert(grid, 3))]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_minhash_against_brute_force(docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, words=4).collect()}
    sets = {}
    for r in docs.where("doc_id is not null").collect():
        words = re.findall(r"[^\x20\x09-\x0d]+", r.text or "")
        sets[r.doc_id] = {tuple(words[k:k + 4]) for k in range(max(len(words) - 3, 1))} if words else set()
    for own, shingles in sets.items():
        near = [o for o, s in sets.items() if shingles and s and 100 * len(s & shingles) >= 80 * len(s | shingles)]
        assert got[own] == (len(shingles), min(near, default=own))
    kept = minhash.without_copies(docs, words=4)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect())[:6] == [0, 1, 4, 5, 6, 8]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_language(docs):
    names, logs = language.learn(docs, F.lit(True))
    got = {r.doc_id: r for r in language.predict(docs, (names, logs)).collect()}
    assert got[4].lang_pred == got[5].lang_pred == got[9].lang_pred == "und" and got[1].lang_pred == "en"
    assert language.predict(docs, language.learn(docs, F.lit(False))).where("lang_pred <> 'und'").count() == 0


def test_pivots_measured_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 16))
    x = np.repeat(base, 5, axis=0) + rng.standard_normal((200, 16)) * 0.08
    rows = [(k, v.tolist(), k % 2) for k, v in enumerate(x)] + [(900, None, 0), (901, [0.0] * 16, 0), (902, x[0].tolist(), None)]
    got = {r.vec_id: r for r in pivots.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98) & (np.arange(200)[:, None] % 2 == np.arange(200)[None, :] % 2)
    np.fill_diagonal(near, False)
    assert sum(got[k].n_links for k in range(200)) >= 0.9 * near.sum() > 0
    assert all(got[k].n_links <= near[k].sum() for k in range(200))
    assert [got[k].n_links for k in (900, 901, 902)] == [0, 0, 0]


def test_toxicity_locates_sentences(spark):
    rows = [(k, f"Calm words stand here. {'You vile creature there' if k % 2 else 'You kind friend there'}. More calm words.") for k in range(80)]
    docs = spark.createDataFrame(rows + [(200, None), (201, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(80)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.scored(docs, toxicity.learn(docs, labels)).collect()}
    assert all((got[k].score >= 0.7) == bool(k % 2) for k in range(80)) and got[200].score == got[201].score == 0
    spot, = got[1].sentences
    assert dict(rows)[1][spot["start"]:spot["end"]].startswith("You vile")
    assert toxicity.without_toxic(docs, labels).count() == 42
    assert toxicity.scored(docs, toxicity.learn(docs, labels.limit(0))).where("score <> 0").count() == 0


def _without_repeats(texts):
    """SHA-256 by document of what is left of (doc_id, text), in plain Python."""
    seen, want = {}, {}
    for doc_id, text in sorted(texts):
        body = text.encode()
        mask = bytearray(len(body))
        for k in range(len(body) - 49):
            if seen.get(body[k:k + 50], doc_id) < doc_id:
                mask[k:k + 50] = b"\1" * 50
            seen.setdefault(body[k:k + 50], doc_id)
        want[doc_id] = hashlib.sha256(bytes(b for b, m in zip(body, mask, strict=True) if not m)).hexdigest()
    return want


def test_suffixes_against_brute_force(docs):
    want = _without_repeats({(r.doc_id, r.text or "") for r in docs.where("doc_id is not null").collect()})
    got = suffixes.dedup(docs, 50).collect()
    assert len(got) == docs.count()
    assert all(hashlib.sha256(r.kept).hexdigest() == want[r.doc_id] for r in got if r.doc_id is not None)
    assert suffixes.dedup(docs.limit(0)).count() == 0


def test_suffixes_of_very_long_texts(spark):
    """Texts that come in several pieces, with shared passages across the borders of the pieces."""
    rng = np.random.default_rng(11)
    own = lambda n: "".join(map(chr, rng.integers(97, 110, n)))
    shared = own(450_000)
    texts = [(1, own(350_017) + shared), (2, own(90_001) + shared[:400_123] + own(250_000) + shared[:77]), (3, shared[299_980:300_090]), (4, "x")]
    want = _without_repeats(texts)
    got = suffixes.dedup(spark.createDataFrame(texts, "doc_id long, text string"), 50).collect()
    assert max(len(t) for _, t in texts) > 2 * suffixes.SLICE
    assert {r.doc_id: hashlib.sha256(r.kept).hexdigest() for r in got} == want


def test_a_process_keeps_its_encoder():
    first, second = (packing.encoder(tokenizer_path(), 1)[0] for _ in range(2))
    assert first is second


def test_tasks_of_other_operators_drop_the_kept_encoder():
    row = {"id": 1, "n": 1, "block": 0, "root": 1, "signs": bytes(2 * minhash.HASHES), "bands": np.zeros(minhash.BANDS, np.int64), "own": bytes(8)}
    for task in (
        lambda: minhash._linked_in_cell(80)((0, 0, 0), pd.DataFrame([row])),
        lambda: list(toxicity._scorer(SimpleNamespace(value={}), 0.5)(iter([]))),
    ):
        before = packing.encoder(tokenizer_path(), 1)[0]
        task()
        assert packing.encoder(tokenizer_path(), 1)[0] is not before


def test_a_run_between_white_space_is_put_together_once(monkeypatch):
    class Counted(dict):
        def __missing__(self, piece):
            asked.append(piece)
            return piece.encode()

    asked = []
    monkeypatch.setattr(packing, "KEPT_RUNS", 1)
    runs = packing._Runs(Counted())
    assert [runs["don't,"], runs["don't,"], runs["b2"], runs["b2"]] == [b"don't,", b"don't,", b"b2", b"b2"]
    # The second run finds the table full.
    assert asked == ["don", "'t", ",", "b", "2", "b", "2"]
