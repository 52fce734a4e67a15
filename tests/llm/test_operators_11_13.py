"""Filter interaction, source divergence and tokeniser fertility on small tables, against SQL and plain Python."""

from __future__ import annotations

import collections
import math
import re

import compare
import numpy as np
import pytest
from pyspark import cloudpickle

from caremart.llm import divergence, fertility, interaction, registry
from caremart.llm.divergence import PerfectHash
from caremart.llm.words import blocks

WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, kept boolean, part string, row string, `a.b` int, term string"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(autouse=True)
def settings_travel():
    """Changed settings of a module go to the workers with its functions."""
    for module in (divergence, fertility):
        cloudpickle.register_pickle_by_value(module)
    yield
    for module in (divergence, fertility):
        cloudpickle.unregister_pickle_by_value(module)


def _docs(spark, rows):
    return spark.createDataFrame([(*r, None, "p", "r", 1, "t") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    words = [f"w{k}" for k in range(60)] + ["Été", "ñandú", "日本", "STOP", "a&&&", "b#", "x|y", "don't"]
    out = []
    for k in range(90):
        n = int(rng.integers(1, 400))
        text = " ".join(rng.choice(words, n, p=None)) + ("\n" if k % 3 else "\t\x0b") + "line again here\n" * (k % 4)
        out.append((k, text.upper() if k % 11 == 0 else text, ["en", "fr", None, ""][k % 4], f"s{k % 5}" if k % 9 else None))
    shared = out[5][1]
    out += [(200 + k, shared, "en", "s0") for k in range(12)] + [(205, shared, "en", "s0"), (None, shared, "en", "s1"), (5, "other text", "fr", "s9")]
    out += [(300, None, "en", None), (301, "", None, "s1"), (302, " \t\n\x0c", "de", "lonely"), (303, "one", "de", "s0"), (304, "same " * 900, "en", "s2")]
    return out


def _held_in_sql(query, **tables):
    import duckdb

    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame.toArrow())
    result = con.execute(query)
    return compare.canonical([d[0] for d in result.description], result.fetchall())


def test_interaction_equals_sql(spark, rows):
    docs = _docs(spark, rows)
    labels = spark.createDataFrame([(k, k % 2, k % 3) for k in range(0, 300, 2)] + [(4, 1, 1), (4, None, None), (None, 1, 1)], LABELS)
    out = interaction.audit(docs, labels)
    assert compare.differences(compare.canonical(out.columns, out.collect()), _held_in_sql(registry._OP11, documents=docs, labels=labels)) is None
    assert interaction.audit(docs.limit(0), labels).count() == 0
    assert interaction.audit(docs, labels.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


def test_interaction_over_many_ranges_and_common_texts(spark, rows, monkeypatch):
    monkeypatch.setattr(interaction, "RANGE_BITS", 3)
    monkeypatch.setattr(interaction, "COMMON_PARTS", 10)
    docs = _docs(spark, rows).repartition(5)
    labels = spark.createDataFrame([(k, 1, 1) for k in range(0, 300, 3)], LABELS)
    out = interaction.audit(docs, labels)
    assert compare.differences(compare.canonical(out.columns, out.collect()), _held_in_sql(registry._OP11, documents=docs, labels=labels)) is None


def test_posting_lists_merge_like_sets():
    rng = np.random.default_rng(1)
    lists = [np.sort(rng.choice(500, n, replace=False)).astype(np.int32) for n in (0, 1, 40, 300, 500)]
    for subset, got in enumerate(interaction.unions(lists)):
        want = sorted(set().union(*[set(x.tolist()) for k, x in enumerate(lists) if subset >> k & 1]))
        assert got.tolist() == want
    for a in lists:
        for b in lists:
            assert interaction.difference(a, b).tolist() == sorted(set(a.tolist()) - set(b.tolist()))
    assert len(interaction.orders("ABCDE")) == 600


def test_divergence_equals_sql(spark, rows):
    docs = _docs(spark, rows)
    out = divergence.audit(docs, min_docs=10, top=10)
    want = _held_in_sql(registry._OP12, documents=docs)
    assert len(want[1]) > 200 and compare.differences(compare.canonical(out.columns, out.collect()), want) is None
    assert divergence.audit(docs.limit(0)).count() == 0


def test_divergence_with_small_shards_batches_and_slots(spark, rows, monkeypatch):
    """Several shards a language, blocks a shard, readings of the texts, and arrays emptied after every slice."""
    for name, value in (("SHARD_TERMS", 7), ("BLOCK", 3), ("BROADCAST_BYTES", 400), ("DENSE_BYTES", 100), ("HELD_TERMS", 20)):
        monkeypatch.setattr(divergence, name, value)
    docs = _docs(spark, rows)
    out = divergence.audit(docs)
    assert compare.differences(compare.canonical(out.columns, out.collect()), _held_in_sql(registry._OP12, documents=docs)) is None


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64)
    table = PerfectHash.of(keys)
    again = PerfectHash.from_bytes(table.to_bytes())
    assert sorted(again.slots(keys).tolist()) == list(range(n))
    assert len(again.slots(keys ^ np.uint64(1))) == n
    assert PerfectHash.of(np.array([7, 7], np.uint64)) is None


def test_shares_are_exact_beyond_64_bits():
    counts, whole = [0, 10 ** 10, 4 * 10 ** 12], 10 ** 13
    assert divergence.shares(np.array(counts), np.array(whole)).tolist() == [1 + 10 ** 9 * (c + 2) // whole for c in counts]


def test_blocks_cut_no_word():
    raw = ("a bb  ccc\x0b" * 50 + "long" * 30).encode()
    for limit in (1, 3, 7, 1000):
        assert [w for b in blocks(raw, limit) for w in b.split()] == raw.split()
    assert list(blocks(b"")) == []


def _base(text):
    words = re.findall(WORD, text or "")
    places = collections.defaultdict(list)
    for k in range(len(words) - 7):
        places[tuple(words[k:k + 8])].append(k)
    covered = {p for ks in places.values() if len(ks) > 1 for k in ks for p in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


@pytest.fixture(scope="module")
def vocabularies():
    import public_tokenizers

    return registry.tokenizer_path("piece_bpe_32k.model"), registry.tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _tokens(words, vocabularies):
    """(pieces of all words, number of ranks) by the libraries alone."""
    import base64

    import sentencepiece
    import tiktoken

    pieces, ranks, pattern = vocabularies
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces)
    merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks, "rb"))}
    bpe = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
    ids = [t for w in words for t in sp.encode(w)]
    return ids, sum(len(bpe.encode_ordinary(" " + w)) for w in words), [t for t in ids if sp.is_byte(t)]


def test_fertility_measures_equal_plain_python(spark, rows, vocabularies, monkeypatch):
    monkeypatch.setattr(fertility, "SLICE", 3000)
    monkeypatch.setattr(fertility, "KEPT_WORDS", 30)
    out = fertility.measured(_docs(spark, rows), *vocabularies).collect()
    assert len(out) == len(rows)
    want = collections.Counter((r[0], *_base(r[1])) for r in rows)
    assert collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out) == want
    texts = {r[0]: r[1] for r in rows[:90]}
    for r in [r for r in out if r.doc_id is not None and r.doc_id < 90 and r.doc_id != 5][::7]:
        ids, ranks, single = _tokens(re.findall(WORD, texts[r.doc_id]), vocabularies)
        count = collections.Counter(ids).values()
        entropy = -sum(c / len(ids) * math.log2(c / len(ids)) for c in count)
        assert (r.n_pieces, r.n_ranks, r.n_fallback) == (len(ids), ranks, len(single))
        assert r.token_entropy == pytest.approx(entropy, abs=1e-9) and r.chars_per_piece == r.word_chars / len(ids)
    failed = {r.doc_id: r.base_failed for r in out}
    assert failed[300] and failed[301] and failed[302] and failed[304]


def test_repeated_words_of_a_long_text():
    rng = np.random.default_rng(2)
    numbers = np.concatenate([rng.integers(0, 50, 4000), np.tile(np.arange(100, 109), 3)])
    got = fertility.repeated_words(numbers, np.zeros(len(numbers), np.int64), 8)
    seen = collections.defaultdict(list)
    for k in range(len(numbers) - 7):
        seen[tuple(numbers[k:k + 8])].append(k)
    want = np.zeros(len(numbers), bool)
    for ks in seen.values():
        for k in ks if len(ks) > 1 else ():
            want[k:k + 8] = True
    assert (got == want).all() and got[-27:].all()


def test_fertility_keeps_clean_texts_and_rejects_odd_ones(spark, vocabularies):
    rng = np.random.default_rng(8)
    words = [line for line in "the of and water letter people number garden window morning reader paper simple common river".split()]
    rows = [(k, " ".join(rng.choice(words, 150)), "en", "s") for k in range(600)]
    rows += [(900, " ".join(f"{w}###" for w in rng.choice(words, 150)), "en", "s"), (901, "".join(map(chr, rng.integers(0x2800, 0x28FF, 300))), "en", "s"),
             (902, " ".join(f"{w[::-1]}qxzj" for w in rng.choice(words, 150)), "en", "s"), (903, None, None, None), (904, "x " * 30, "zz", "s")]
    rows += [(1000 + k, " ".join(rng.choice(words, 150)), f"rare{k}", "s") for k in range(5)]
    docs = _docs(spark, rows)
    out = {r.doc_id: r for r in fertility.judged(docs, *vocabularies).collect()}
    assert all(out[k].kept for k in [*range(600), *range(1000, 1005)])
    assert not any(out[k].kept for k in (900, 901, 902, 903, 904)) and "letters_per_piece" in out[900].outside
    # Too few documents for any band: the base rules decide.
    few = fertility.judged(docs.where("doc_id BETWEEN 895 AND 903"), *vocabularies).collect()
    assert {r.doc_id: r.kept for r in few} == {900: True, 901: False, 902: True, 903: False}
    assert fertility.judged(docs.limit(0), *vocabularies).count() == 0


def test_bands_follow_the_quartiles(spark):
    rows = [("lang:en", "script:Latin", 7, False, *[float(v)] * 2, 0.0, 0.0, 5.0) for v in np.linspace(2, 3, 401)]
    frame = spark.createDataFrame(
        rows, "own string, shared string, len_class int, base_failed boolean, chars_per_piece double, letters_per_piece double, letters_per_rank double, "
        "fallback_share double, token_entropy double")
    found = {r.scope: r for r in fertility.bands(frame, width=2.0, min_group=100).collect()}
    assert set(found) == {"lang:en", "script:Latin", "all"}
    assert found["all"].chars_per_piece_low == pytest.approx(2.25 - 2 * 0.5, abs=0.06)
    assert found["all"].chars_per_piece_high == pytest.approx(2.75 + 2 * 0.5, abs=0.06)


def test_scripts_by_first_bytes():
    table = fertility._script_table()
    names = [fertility.NO_SCRIPT, *fertility.SCRIPTS]

    def script(char):
        raw = (char + " ").encode()
        return names[table[raw[0] << 8 | raw[1]]]

    assert [script(c) for c in "aZéПש日한ไあ1 €"] == [
        "Latin", "Latin", "Latin", "Cyrillic", "Hebrew", "Han", "Hangul", "Thai", "Kana", "none", "none", "none"]
