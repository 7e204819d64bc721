"""SimHash groups, components, shards, syncmers."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from squall.llm import components, shards, simhash, syncmers
from tests.llm import data


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\n", " ").replace("\t", " ")
             .split(" ") if w]
    if not words:
        return 0
    own = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in own]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, most=3):
    fps = [int(f) for f in fps]
    label = list(range(len(fps)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= most:
                a, b = top(i), top(j)
                label[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(fps))]


@pytest.mark.parametrize("text", [t for _, t, _ in data.EDGE])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_in_chunks(monkeypatch):
    whole = simhash.fingerprint(data.LONG)
    monkeypatch.setattr(simhash, "CHUNK", 1000)
    assert simhash.fingerprint(data.LONG) == whole


def test_fingerprint_is_sparks_hash(spark):
    from pyspark.sql import functions as F
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % 2**64 == xxhash.xxh64_intdigest("a b c", 42)


def test_each_link_meets_at_a_key_and_passes_its_chain():
    rng = np.random.default_rng(1)
    for _ in range(3000):
        x = int(rng.integers(0, 2**63))
        bits = rng.choice(64, int(rng.integers(0, 6)), replace=False)
        y = x
        for b in bits:
            y ^= 1 << int(b)
        d = np.array([x ^ y], np.uint64)
        met = any((x ^ y) & m == 0 and simhash.chain(d, i, 3)[0] for i, m in simhash.key_masks(3))
        assert met == (len(bits) <= 3)


def test_refined_keys_lose_no_link():
    for i, m in simhash.key_masks(3):
        for _ in range(simhash.REFINEMENTS):
            finer = simhash.refined(m, 3)
            rest = [b for b in range(64) if not m >> b & 1]
            for bits in ([rest[0], rest[-1], rest[len(rest) // 2]], rest[:3], rest[-3:]):
                assert any(all(not f >> b & 1 for b in bits) for f in finer)
            m = finer[0]


@pytest.mark.parametrize("hot", [simhash.HOT_KEY, 6])
def test_links_and_components_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_KEY", hot)
    rng = np.random.default_rng(2)
    fps = set()
    for x in rng.integers(0, 2**63, 25):
        for _ in range(40):
            y = int(x)
            for b in rng.integers(0, 64, int(rng.integers(0, 5))):
                y ^= 1 << int(b)
            fps.add(y)
    fps = np.array(sorted(fps), np.uint64)
    df = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    links = simhash.links(df)
    assert all(bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= 3 for r in links.collect())
    label = {r.node: r.label for r in components.connected(links).collect()}
    groups = {}
    for f, g in zip(fps.view(np.int64).tolist(), plain_components(fps)):
        groups.setdefault(g, set()).add(label.get(f, f))
    assert all(len(v) == 1 for v in groups.values())
    assert len({next(iter(v)) for v in groups.values()}) == len(groups)


def test_long_chains_settle(spark):
    path = [(i, i + 1) for i in range(200)] + [(1000, 1000), (2000, 2001)]
    got = {r.node: r.label for r in components.connected(spark.createDataFrame(path, "a long, b long")).collect()}
    assert {got[i] for i in range(201)} == {0} and got[2001] == got[2000] == 2000 and 1000 not in got


def test_no_links(spark):
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_of_edge_rows(spark, tmp):
    docs = data.on_disk(data.edge(spark), f"{tmp}/docs")
    got = simhash.near_duplicates(docs).collect()
    fps = [plain_fingerprint(t) for _, t, _ in data.EDGE]
    label = plain_components(fps)
    least = {}
    for (i, _, _), g in zip(data.EDGE, label):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    want = sorted((i or 0, f"{f:016x}", least.get(g) or 0) for (i, _, _), f, g in zip(data.EDGE, fps, label))
    assert sorted((r.doc_id or 0, r.fingerprint, r.component_id or 0) for r in got) == want
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(least.get(g) or 0 for g in set(label))
    assert simhash.near_duplicates(data.empty(spark)).count() == 0
    assert simhash.deduplicate(data.empty(spark)).count() == 0


def test_shards_are_an_exact_split(spark, tmp):
    docs = data.on_disk(data.edge(spark), f"{tmp}/docs")
    got = shards.shard_documents(docs).collect()
    texts = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in data.EDGE)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == texts
    count = Counter(r.shard for r in got)
    assert set(count) == set(range(8)) and max(count.values()) - min(count.values()) <= 1
    for s in count:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(count[s]))
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    again = shards.shard_documents(docs).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert shards.shard_documents(data.empty(spark)).count() == 0


def test_shuffle_over_many_buckets(spark, tmp):
    docs = spark.range(5000).selectExpr("id AS doc_id", "repeat('ab', 20) AS text")
    docs = data.on_disk(docs, f"{tmp}/docs")
    got = shards.shuffle_to_shards(docs, f"{tmp}/out", shards=3, bucket_bytes=9000).orderBy("shard", "slot").collect()
    order = [r.doc_id for r in got]
    assert sorted(order) == list(range(5000)) and Counter(r.shard for r in got) == {0: 1667, 1: 1667, 2: 1666}
    assert abs(np.corrcoef(order, range(5000))[0, 1]) < 0.1


def test_shard_places():
    for total in (1, 7, 8, 9, 100):
        at = np.arange(total)
        s = shards.shard_of(at, total, 8)
        assert (np.diff(s) >= 0).all() and (at - shards.shard_start(s, total, 8) >= 0).all()
        assert max(Counter(s.tolist()).values()) - total // 8 <= 1


def plain_syncmers(text):
    c = np.array([ord(x) for x in text], np.uint64) + np.uint64(1)
    out = []
    for i in range(len(text) - syncmers.K + 1):
        inner = [int(syncmers.mix(syncmers._grams(c[i + j:i + j + syncmers.S], syncmers.S))[0]) for j in range(syncmers.WINDOW)]
        if min(inner) in (inner[0], inner[-1]):
            out.append(i)
    return out


@pytest.mark.parametrize("text", ["", "short", data.COMMON, "Ünïcode 文字 🙂 " * 9, "aaaaaaaaaaaaaaaaaaaaaaa", data.LONG[:700]])
def test_closed_syncmers(text):
    at, h = syncmers.closed_syncmers(np.frombuffer(text.encode("utf-32-le"), "<u4"))
    assert at.tolist() == plain_syncmers(text)
    assert all((text[i:i + syncmers.K] == text[j:j + syncmers.K]) == (a == b)
               for i, a in zip(at[:60], h) for j, b in zip(at[:60], h))


def test_anchors_match_a_moved_passage_by_place():
    passage = data.LONG[5000:5600]
    votes = syncmers.offset_votes("some other words first " + passage, passage)
    assert max(votes, key=votes.get) == -len("some other words first ")


def test_fingerprints_of_edge_rows(spark):
    found = syncmers.fingerprint_documents(data.edge(spark)).collect()
    rows = [(i, t or "") for i, t, _ in sorted(data.EDGE, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))]
    want = [(i, len(t), hashlib.sha256(syncmers.edited(t, n).encode()).hexdigest())
            for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1])]
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == Counter(want)
    got = {r.doc_id: r for r in found}
    assert all(got[i].near_edited > 0.4 for i in (5, 6, 7, 8)) and all(0 <= r.near_next <= 1 for r in found)
    assert got[5].fingerprint == got[7].fingerprint and len({r.fingerprint for r in found if r.doc_id == 10}) == 1
    assert got[1].near_next == 1.0 and got[8].near_next == 0.0
    assert syncmers.fingerprint_documents(data.empty(spark)).count() == 0


@pytest.mark.parametrize("n", [4, 11, 12, 13, 24, 47, 48, 49, 63])
def test_near_copies_of_any_length_share_anchors(n):
    text = data.LONG[3000:3000 + n]
    more, other = syncmers.sketches([text + "x", "Zq" + data.COMMON[n:2 * n] + "#"])
    (own,), (again,) = syncmers.sketches([text]), syncmers.sketches([text])
    assert own.tolist() == again.tolist()
    assert syncmers.likeness(own, more) > (0.3 if n >= 24 else 0) and syncmers.likeness(own, other) == 0.0


@pytest.mark.parametrize("n", [48, 55, 63])
def test_a_text_cut_short_stays_like_itself(spark, n):
    """The next text is empty, so the edited one is shorter by a quarter."""
    text = data.LONG[3000:3000 + n]
    rows = syncmers.fingerprint_documents(data.documents(spark, [(1, text, "s"), (2, "", "s")])).collect()
    assert next(r.near_edited for r in rows if r.doc_id == 1) > 0.3


def test_a_single_document_follows_itself(spark):
    r = syncmers.fingerprint_documents(data.documents(spark, [(4, data.COMMON, "s")])).first()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(syncmers.edited(data.COMMON, data.COMMON).encode()).hexdigest()


@pytest.mark.parametrize("kind", ["string", "struct"])
def test_a_column_called_metadata_changes_nothing(spark, tmp, kind):
    """Row identity, which op1, op3, op5, op7 and op8 take from files, is not that column's."""
    from squall.llm import common, licenses, toxicity
    plain = data.on_disk(data.edge(spark).coalesce(1), f"{tmp}/plain")
    other = F.lit("x") if kind == "string" else F.struct(F.lit("file:/one").alias("file_path"), F.lit(0).cast("long").alias("row_index"))
    clash = data.on_disk(plain.withColumn("_metadata", other).coalesce(1), f"{tmp}/clash")
    for df in (plain, clash, clash.where("true")):
        rows, mark = common.placed(df)
        assert rows.select(mark.alias("m")).distinct().count() == len(data.EDGE)
        rows, chunk = toxicity.with_chunks(df)
        assert rows.select(chunk).distinct().count() == 1 and set(df.columns) < set(rows.columns)
    assert licenses.paragraphs(clash).count() == licenses.paragraphs(plain).count()
    a, b = (Counter((r.doc_id, r.size, r.text_crc32) for r in shards.shard_documents(df).collect()) for df in (plain, clash))
    assert a == b
