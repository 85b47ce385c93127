import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.rows import documents, frame
from vecflow.llm import common, packing, token_store, tokens


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(common.tokenizer_path())
    t.encode_special_tokens = True
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_remembered_forms_give_the_tokenizers_ids(x):
    x = x.encode("utf-8", "ignore").decode()
    t = Tokenizer.from_file(common.tokenizer_path()) if not hasattr(test_remembered_forms_give_the_tokenizers_ids, "t") else test_remembered_forms_give_the_tokenizers_ids.t
    test_remembered_forms_give_the_tokenizers_ids.t = t
    t.encode_special_tokens = True
    assert tokens.encoder(common.tokenizer_path()).encode(x).tolist() == t.encode(x, add_special_tokens=False).ids


def test_latin_forms_are_the_patterns():
    e = tokens.encoder(common.tokenizer_path())
    assert e.latin
    for c in map(chr, range(0x260)):
        for x in (c, "a" + c, " " + c + c, c + "a", "1" + c + "1", "  " + c, c + "  b", "'s" + c, "'" + c, "!" + c + "!"):
            assert tokens.latin_forms(x) == (e.any_forms(x) if ord(c) < 0x250 else None), (c, x)
    assert e.forms("naïve Дом's 12") == ["naïve", " Дом", "'s", " 12"]


def test_special_strings_and_white_space(plain):
    e = tokens.encoder(common.tokenizer_path())
    for x in ["<|endoftext|> a", "don't we'll 's ''s x'S", "  a\n\n b \t", "a²b½ ١٢ ǅ _x_", "\u00a0\u2003a", "e\u0301 ", ""]:
        assert e.encode(x).tolist() == plain(x), x


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=50))
def test_coding_round_trip(values):
    v = np.array(values, "<u4")
    control, data = token_store.encode_ranks(v)
    assert len(control) == -(-len(v) // 4)
    assert len(data) == sum(max(1, (x.bit_length() + 7) // 8) for x in values)
    assert token_store.decode_ranks(control, data, len(v)).tolist() == values


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, plain, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_IDS", 500)
    path = str(tmp_path / "t")
    ranks = token_store.write_tokens(frame(spark), common.tokenizer_path(), path)
    got = token_store.read_tokens(spark, path, with_ids=True).collect()
    want = sorted(documents(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(got) == len(want)
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == [w[0] for w in want]
    at = 0
    for r in got:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), crc(ids))
        at += len(ids)
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, r.ids_crc32) for r in got), key=key) == sorted(((i, crc(plain(t) + [0])) for i, t, _ in want), key=key)
    counts = Counter(x for _, t, _ in want for x in plain(t) + [0])
    assert ranks.tolist() == sorted(counts, key=lambda i: (-counts[i], i))


def test_shards_of_hot_ids():
    """Shards rise with the ids; an id of many documents, and rows without one, are spread over several."""
    rng = np.random.default_rng(2)
    ids = np.concatenate((rng.integers(-50, 50, 4000), np.full(3000, 7), np.zeros(3000, np.int64)))
    none = np.arange(len(ids)) >= 7000
    bounds, more = sorted(np.quantile(ids[~none], [i / 20 for i in range(1, 20)], method="nearest").tolist()), 6
    got = token_store.shards_of(ids, none, rng.integers(0, 2**32, len(ids), np.uint64).astype(np.uint32), bounds, more)
    order = np.lexsort((got, np.where(none, -10**6, ids)))
    assert (np.diff(got[order]) >= 0).all() and got.min() == 0 and got.max() == len(bounds) + more
    assert np.bincount(got).max() < 1000 and len(set(got[none])) == 7 and len(set(got[ids == 7])) >= 8
    assert token_store.shards_of(ids[:3], none[:3], np.zeros(3, np.uint32), [], 0).tolist() == [0, 0, 0]


def test_token_files_of_hot_ids(spark, plain, tmp_path):
    """Half of all rows without an id, a quarter of one id: files in order, every document once."""
    rows = [(None, f"none {i}", "xx") for i in range(60)] + [(5, f"five {i}", "xx") for i in range(30)] + [(i, f"own {i}", "xx") for i in range(30)]
    path = str(tmp_path / "t")
    token_store.write_tokens(frame(spark, rows), common.tokenizer_path(), path)
    got = sorted(token_store.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, *_ in rows), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, r.ids_crc32) for r in got), key=key) == sorted(((i, crc(plain(t) + [0])) for i, t, _ in rows), key=key)


def test_packing(spark, plain):
    got = packing.pack(frame(spark), common.tokenizer_path()).collect()
    assert len({r.sequence_id for r in got}) == len(got) and {r.offset for r in got} == {0}
    assert all(r.length == 1 << r.bucket <= 2048 for r in got)
    by_doc = Counter()
    for r in got:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert (len(ids), crc(ids)) == (r.length, r.ids_crc32)
        by_doc[r.doc_id, r.start, tuple(ids)] += 1
    want = Counter()
    for i, t, _ in documents():
        ids, at = plain(t) + [1], 0
        for n in packing.pieces_of(len(ids)):
            want[i, at, tuple(ids[at : at + n])] += 1
            at += n
        assert at == len(ids)
    assert by_doc == want


def test_sequences_lie_by_length_whatever_the_splits(spark, tmp_path):
    one, many = (packing.pack(frame(spark).repartition(n), common.tokenizer_path()) for n in (1, 7))
    name = lambda d: Counter((r.doc_id, r.start, r.ids_crc32, r.sequence_id) for r in d.collect())
    assert name(one) == name(many)
    packing.write(many, str(tmp_path / "packed"))
    folders = {p.name for p in (tmp_path / "packed").iterdir() if p.is_dir()}
    assert folders == {f"bucket={r.bucket}" for r in many.select("bucket").distinct().collect()}
    assert spark.read.parquet(str(tmp_path / "packed" / "bucket=3")).where("length <> 8").isEmpty()


def test_added_tokens_are_the_librarys(spark, tmp_path):
    library = Tokenizer.from_file(common.tokenizer_path())
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|><|endoftext|>\n y<|endoftext", "plain"]
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts)}
    assert want[0] == [64, 220, 50256, 275]
    docs = frame(spark, [(i, t, "xx") for i, t in enumerate(texts)])
    token_store.write_tokens(docs, common.tokenizer_path(), str(tmp_path / "t"))
    got = {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in token_store.read_tokens(spark, str(tmp_path / "t"), with_ids=True).collect()}
    assert got == {i: ids + [0] for i, ids in want.items()}
    packed: dict = {}
    for r in packing.pack(docs, common.tokenizer_path()).orderBy("doc_id", "start").collect():
        packed.setdefault(r.doc_id, []).extend(np.frombuffer(bytes(r.ids), "<u4").tolist())
    assert packed == {i: ids + [1] for i, ids in want.items()}


def test_pieces():
    assert packing.pieces_of(5000) == [2048, 2048, 512, 256, 128, 8] and packing.pieces_of(1) == [1] and packing.pieces_of(0) == []


def test_empty_tables(spark, tmp_path):
    none = frame(spark, [])
    token_store.write_tokens(none, common.tokenizer_path(), str(tmp_path / "t"))
    assert token_store.read_tokens(spark, str(tmp_path / "t")).count() == 0
    assert packing.pack(none, common.tokenizer_path()).count() == 0
