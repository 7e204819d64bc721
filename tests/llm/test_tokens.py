import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from squall.llm import packing, repair
from squall.llm.tokens import TextEncoder, default_tokenizer, encoder
from tests.llm import data


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(default_tokenizer())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_pieces_give_the_ids_of_whole_texts(plain):
    rng = random.Random(5)
    parts = ["a", "B", "É", "é", "J̌", "ǰ", "İ", "ß", "Σ", "ς", " ", "  ", "\n", "\t", ".", ",", "...", "'s",
             "'S", "'re", "12", "½", "<|endoftext|>", "<|STARTOFTEXT|>", "文", " ", " ", "\x1c", "\x85", "🙂",
             "-", "µ", "ª", "|", "x.y", ",a"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(5000)] + [None]
    ids, counts = encoder(default_tokenizer()).encode(pa.array(texts))
    ends = np.cumsum(counts)
    for text, a, b in zip(texts, ends - counts, ends):
        assert ids[a:b].tolist() == plain(text), repr(text)


def test_very_long_text_in_parts(plain, monkeypatch):
    from squall.llm import tokens
    monkeypatch.setattr(tokens, "SLICE_BYTES", 1000)
    ids, counts = TextEncoder(default_tokenizer()).encode(pa.array([data.LONG]))
    assert ids.tolist() == plain(data.LONG) and counts.tolist() == [len(ids)]


@pytest.mark.parametrize("ids", [
    np.empty(0, np.uint32), np.array([7], np.uint32), np.full(1001, 9, np.uint32),
    np.tile(np.array([3, 1, 4, 1, 5], np.uint32), 500),
    np.random.default_rng(1).zipf(1.3, 30_000).clip(max=40_000).astype(np.uint32),
    np.random.default_rng(2).integers(0, 2, 5000).astype(np.uint32),
])
def test_grammar_expands_to_its_ids(ids):
    g = repair.compress(ids, min_uses=2)
    assert (repair.expand(g) == ids).all()
    assert (g.lengths >= 2).all() and g.sizes()[g.symbols].sum() == len(ids)


def test_grammar_shortens_repeats():
    ids = np.tile(np.random.default_rng(3).integers(0, 5000, 300), 40).astype(np.uint32)
    assert len(repair.compress(ids).symbols) < len(ids) / 8


def test_any_range_of_a_shard_file(monkeypatch):
    monkeypatch.setattr(repair, "INDEX_STEP", 16)
    ids = np.random.default_rng(4).zipf(1.4, 20_000).clip(max=900).astype(np.uint32)
    shard = repair.ShardFile(repair.pack_shard(ids, [(None, 0, 5), (3, 5, len(ids) - 5)]))
    for a, b in [(0, 0), (0, 1), (17, 18), (5, 20_000), (19_999, 20_000), (3000, 3300), (0, 20_000)]:
        assert (shard.read(a, b) == ids[a:b]).all()
    assert shard.docs[0].tolist() == [0, 3] and shard.docs[1].tolist() == [0, 1]


def test_damaged_file_is_refused():
    body = bytearray(repair.pack_shard(np.arange(100, dtype=np.uint32), [(1, 0, 100)]))
    body[120] ^= 1
    with pytest.raises(ValueError):
        repair.ShardFile(bytes(body))


def _expected(rows, plain, end_id):
    at = 0
    for key, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*plain(text), end_id], "<u4")
        yield key, at, len(ids), zlib.crc32(ids)
        at += len(ids)


@pytest.mark.parametrize("shard_ids", [repair.SHARD_IDS, 1000])
def test_token_files_roundtrip(spark, tmp, plain, shard_ids):
    """A shard of 1000 ids makes the long text run through many files."""
    manifest = repair.write_token_files(data.edge(spark), f"file://{tmp}/tokens", shard_ids=shard_ids)
    got = repair.read_token_files(manifest).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == list(_expected(data.EDGE, plain, 2))
    assert shard_ids > 1000 or manifest.count() > 50


def test_token_files_of_an_empty_table(spark):
    assert repair.token_files_roundtrip(data.empty(spark)).count() == 0


def _check_pieces(rows, pieces, plain, limits=packing.Limits()):
    texts = {}
    for key, text, _ in rows:
        texts.setdefault(key, np.array([*plain(text), 1], "<u4"))
    total = sum(len(texts[k]) for k, _, _ in rows)
    assert sum(p.length for p in pieces) == total
    for p in pieces:
        ids = texts[p.doc_id]
        assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length])
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    for parts in sequences.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == np.cumsum([0] + [p.length for p in parts])[:-1].tolist()
        n = sum(p.length for p in parts)
        assert n <= limits.tokens and len(parts) <= limits.segments and (n == limits.tokens or n & (n - 1) == 0)
    return sequences


def test_packing_places_each_id_once(spark, plain):
    pieces = packing.pack_documents(data.edge(spark)).collect()
    _check_pieces(data.EDGE, pieces, plain)
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length))
    for key, parts in by_doc.items():
        if key != 10:  # that row comes twice
            parts.sort()
            assert [a for a, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()


def test_packing_of_an_empty_table(spark):
    assert packing.pack_documents(data.empty(spark)).count() == 0


def _examples(n, seed=0):
    rng = np.random.default_rng(seed)
    for i in range(n):
        ids = rng.integers(0, 9, rng.integers(1, 900)).astype("<u4")
        yield packing.Example(i, ids, 0, len(ids), rng.random(len(ids)) < 0.4)


def test_three_limits_hold_without_cuts():
    limits = packing.Limits(tokens=1024, segments=3, loss=420)
    got = list(packing.pack_stream(_examples(400), limits, cut=False, queue_tokens=50_000))
    assert sorted(e.key for s in got for e in s) == list(range(400))
    for s in got:
        assert sum(len(e.ids) for e in s) <= 1024 and len(s) <= 3 and sum(e.demand()[1] for e in s) <= 420


def test_three_limits_hold_with_cuts():
    limits = packing.Limits(tokens=512, segments=4, loss=200)
    whole = {e.key: e.ids for e in _examples(300, 1)}
    parts = {}
    for s in packing.pack_stream(_examples(300, 1), limits, queue_tokens=20_000):
        assert sum(len(e.ids) for e in s) <= 512 and len(s) <= 4 and sum(e.demand()[1] for e in s) <= 200
        for e in s:
            parts.setdefault(e.key, []).append((e.start, e.ids))
    for key, ids in whole.items():
        assert (np.concatenate([x for _, x in sorted(parts[key], key=lambda p: p[0])]) == ids).all()


def test_many_tiny_documents_stay_within_segments():
    tiny = (packing.Example(i, np.zeros(3, "<u4"), 0, 3) for i in range(20_000))
    limits = packing.Limits()
    sizes = [(len(s), sum(len(e.ids) for e in s)) for s in packing.pack_stream(tiny, limits, queue_tokens=9_000)]
    assert max(n for n, _ in sizes) <= limits.segments and sum(t for _, t in sizes) == 60_000
    assert all(t & (t - 1) == 0 for _, t in sizes)


def test_an_example_beyond_a_limit_is_an_error():
    with pytest.raises(ValueError):
        list(packing.pack_stream(iter([packing.Example(1, np.zeros(600, "<u4"), 0, 600)]),
                                 packing.Limits(tokens=512, loss=512), cut=False))


def test_instruction_examples(spark):
    rows = [(1, [1, 2, 3], [False, True, True]), (2, [4] * 40, None), (3, None, None), (4, [5] * 10, [True] * 10)]
    got = packing.pack_examples(spark.createDataFrame(rows, "key long, ids array<int>, loss array<boolean>"),
                                packing.Limits(tokens=64, segments=2, loss=45)).collect()
    assert sorted((r.doc_id, r.length) for r in got) == [(1, 3), (2, 40), (4, 10)]


def test_packing_encodes_few_bytes_at_once():
    """What a task holds while it encodes does not follow from the batches Spark sends."""
    import pyarrow as pa
    sizes = []

    class Encoder:
        def encode(self, texts):
            sizes.append(sum(len(t) for t in texts.to_pylist()))
            return np.ones(len(texts), np.uint32), np.ones(len(texts), np.int64)

    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(["x" * 50_000] * 400)], names=["doc_id", "text"])
    assert [(e.key, e.total) for e in packing.document_examples(iter([batch]), Encoder(), 1)] == [(i, 2) for i in range(400)]
    assert sum(sizes) == 400 * 50_000 and max(sizes) <= 5 << 20
