"""The registered queries and the pipeline on the small driver tables: against SQL, brute force, exact round trips or held-out rows."""

from __future__ import annotations

import hashlib
import re
import zlib

import compare
import numpy as np
import pytest

import corpus_pipeline
from caremart.llm import chunks, lines, minhash, mixing, registry, suffixes
from caremart.llm.common import table

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


@pytest.fixture(scope="module")
def texts(duck):
    return duck.execute("SELECT doc_id, coalesce(text, '') AS text, lang FROM documents").df()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLE[name])
    want = compare.canonical([d[0] for d in result.description], result.fetchall())
    assert want[1] and compare.differences(compare.canonical(df.columns, df.collect()), want) is None


def test_packing_puts_every_id_into_one_gapless_piece(spark, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(registry.tokenizer_path())
    ids = {r.doc_id: np.array(tokenizer.encode(r.text, add_special_tokens=False).ids + [1], "<u4") for r in texts.itertuples()}
    pieces = QUERIES["op5_curve_packing"](spark, SF_DIR).toPandas()
    for doc_id, own in pieces.sort_values("start").groupby("doc_id"):
        whole = ids.pop(doc_id)
        assert (own["doc_tokens"] == len(whole)).all()
        assert own["start"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]] and own["length"].sum() == len(whole)
        assert [zlib.crc32(whole[a:a + n].tobytes()) for a, n in zip(own["start"], own["length"])] == own["ids_crc32"].tolist()
    assert not ids
    for _, own in pieces.sort_values("offset").groupby("sequence_id"):
        assert own["offset"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]] and own["length"].sum() <= 2048


def test_near_duplicates_equal_brute_force(spark, texts):
    sets = {}
    for r in texts.itertuples():
        fold = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text)
        words = re.findall(r"[^\x20\x09-\x0D]+", fold)
        sets[r.doc_id] = {tuple(words[k:k + 4]) for k in range(max(len(words) - 3, 1))} if words else set()
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = QUERIES["op6_minmax_near_dedup"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {k: (len(s), find(k), find(k) == k) for k, s in sets.items()}


def test_language_holds_out_its_rows(spark, texts):
    got = QUERIES["op7_language_id"](spark, SF_DIR).toPandas().merge(texts, on="doc_id")
    assert len(got) == len(texts)
    assert got["held_out"].tolist() == [zlib.crc32(str(k).encode()) % 4 == 2 for k in got["doc_id"]]
    assert (got[got["held_out"]]["lang_pred"] == got[got["held_out"]]["lang"]).mean() > 0.95 and got["score"].between(0, 1).all()


def test_toxicity_holds_out_its_rows(spark, texts):
    got = QUERIES["op9_toxicity"](spark, SF_DIR).toPandas()
    assert len(got) == len(texts) and got["score"].between(0, 1).all()
    assert got["held_out"].tolist() == [zlib.crc32(str(k).encode()) % 3 == 1 for k in got["doc_id"]]
    assert ((got["score"] >= 0.7).astype(int) == got["predicted"]).all()


def _plain_chunks(raw):
    """Ends of the chunks of a text, by the gear hash of the bytes before each place."""
    gear, last, ends = [int(x) for x in chunks._gear()], 0, []
    hashes = [sum(gear[b] << j for j, b in enumerate(reversed(raw[max(k - chunks.WINDOW, 0):k]))) & 0xFFFFFFFF for k in range(1, len(raw) + 1)]
    for k in range(1, len(raw) + 1):
        cut = k >= chunks.WINDOW and not (hashes[k - 1] >> (chunks.WINDOW - 1)) & ((1 << chunks.BITS) - 1)
        if len(raw) - last > chunks.LEAST and k - last >= chunks.LEAST and (cut or k - last == chunks.MOST) and k > last:
            while k < len(raw) and raw[k] & 0xC0 == 0x80:
                k += 1
            if k > last:
                ends.append(k)
                last = k
    return ends + ([len(raw)] if last < len(raw) else [])


def test_chunks_go_where_an_earlier_one_has_them(spark, texts):
    ascii_only = texts[[t.isascii() for t in texts["text"]]].sort_values("doc_id").head(60)
    rows = [(int(r.doc_id), r.text) for r in ascii_only.itertuples()] + [(7000, ascii_only["text"].iloc[3] + " tail"), (7001, "")]
    seen, want = {}, {}
    for doc_id, text in rows:
        raw, last, gone = text.encode(), 0, []
        for end in _plain_chunks(raw):
            piece = raw[last:end]
            if seen.setdefault(piece, (doc_id, last)) != (doc_id, last):
                gone = [*gone[:-1], (gone[-1][0], end)] if gone and gone[-1][1] == last else [*gone, (last, end)]
            last = end
        want[doc_id] = sum(b - a for a, b in gone if b - a >= chunks.LEAST)
    got = chunks.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_removed for r in got} == want and any(want.values())


def test_unlike_texts_under_one_id_are_cut_by_their_own_spans(spark):
    rng = np.random.default_rng(3)
    own = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    shared = own(900)
    first, second = shared + own(200), own(400) + shared + own(200)
    rows = [(1, shared), (7, first), (7, second), (7, second), (8, None), (None, first)]
    got = [(r.doc_id, r.text) for r in chunks.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    texts = [t for k, t in got if k == 7]
    assert len(got) == 6 and len(texts) == 3 and (None, first) in got and (8, None) in got
    assert any(first[950:] in t for t in texts) and sum(second[:380] in t and second[-180:] in t for t in texts) == 2
    assert all(len(t) < 700 for t in texts)


ODD = "doc_id long, text string, lang string, source string, `a.b` int, `q``t` string, row string, id long, key long, least long"


def _odd(spark, rows):
    return spark.createDataFrame([(k, t, "en", s, 1, "q", "r", 5, 6, 7) for k, t, s in rows], ODD)


def test_stages_keep_rows_apart_and_columns_by_their_names(spark):
    page = " ".join(f"word{k}" for k in range(60))
    rows = [(7, page, "s1"), (7, "", "s1"), (7, page + " end", "s2"), (7, page, "s1"), (9, page, "s3"), (3, "another text of five words here", "s1"),
            (None, page, "s1"), (None, None, None)]
    docs = _odd(spark, rows)
    kept = minhash.without_copies(docs, words=4)
    assert kept.columns == docs.columns
    texts = [(r.doc_id, r.text) for r in kept.collect()]
    assert sum(k is None for k, _ in texts) == 2 and (7, "") in texts and (3, rows[5][1]) in texts
    assert sum(bool(t) and k in (7, 9) for k, t in texts) == 1
    assert lines.dedup(docs).columns == docs.columns and lines.dedup(docs).count() == len(rows)
    assert mixing.mixed(docs).columns == docs.columns and mixing.mixed(docs).count() >= len(rows)
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs.limit(0), SF_DIR).columns == docs.columns


def test_runs_under_one_digit_do_not_fall_together():
    """Many different windows around one phrase: no two share digit and content."""
    rng = np.random.default_rng(6)
    n, phrase = 30_000, b"the phrase in common"
    around = rng.integers(97, 123, (n, 30)).astype(np.uint8)
    raw = np.concatenate([np.concatenate([around[:, :15], np.tile(np.frombuffer(phrase, np.uint8), (n, 1)), around[:, 15:]], axis=1)]).ravel()
    _, found = suffixes.runs(raw, np.arange(n + 1) * 50, 50)
    assert found["content"].dtype == np.uint64 and len(np.unique(found["content"])) == n
    same = np.unique(suffixes._digits(found), return_counts=True)[1].max()
    assert same > n // 100, "one digit is shared by many"


def test_suffix_query_equals_brute_force(spark, texts):
    seen, want = {}, {}
    for r in texts.sort_values("doc_id").itertuples():
        raw = r.text.encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 49):
            if seen.setdefault(raw[k:k + 50], r.doc_id) < r.doc_id:
                gone[k:k + 50] = b"\1" * 50
        left = bytes(b for b, g in zip(raw, gone) if not g)
        want[r.doc_id] = (len(raw), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(left).hexdigest())
    got = QUERIES["op10_suffix_dedup"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want


def test_the_first_stage_drops_toxic_documents(spark):
    sf_dir = SF_DIR.replace("0.001", "0.01")
    labels = compare.connect(sf_dir).execute("SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY 1").df().set_index("doc_id")["toxic"]
    stay = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, table(spark, sf_dir, "documents"), sf_dir).select("doc_id").collect()}
    toxic, clean = set(labels[labels == 1].index), set(labels[labels == 0].index)
    # A few dozen toxic texts teach little; README has the figures of larger tables.
    assert len(toxic & stay) <= 0.4 * len(toxic) and len(clean & stay) >= 0.97 * len(clean)


def test_the_pipeline_applies_its_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    held = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF_DIR)
        held[name] = docs.toPandas()
        assert docs.columns == table(spark, SF_DIR, "documents").columns
        docs = spark.createDataFrame(held[name], table(spark, SF_DIR, "documents").schema)
    first = set(held["toxicity"]["doc_id"])
    assert set(held["line_dedup"]["doc_id"]) == first
    texts = held["near_dedup"]
    assert len(texts) < len(held["line_dedup"]) and texts["text"][texts["text"] != ""].is_unique
    assert set(held["mixing"]["doc_id"]) == set(texts["doc_id"]) and len(held["mixing"]) >= len(texts)
    packed = corpus_pipeline.run(spark, SF_DIR).toPandas()
    assert set(packed["doc_id"]) == set(texts["doc_id"])
    assert packed.groupby("sequence_id")["length"].sum().max() <= 2048
