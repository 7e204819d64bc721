"""Toxicity, licences, pivot index, mixing, pipeline."""

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from squall.llm import licenses, mixing, pivots, queries, toxicity
from tests.llm import data

SYLLABLES = "ban ter lo mi ras ken du far sol pe vin gra".split()


def _word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4)))


def _corpus(spark, n=1500):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        words = [_word(rng) for _ in range(rng.randrange(5, 200))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(max(1, len(words) // 25)):
                words.insert(rng.randrange(len(words)), rng.choice(["zhulk", "zhulker", "qwaxi"]))
        rows.append((i, " ".join(words), "s"))
        if i % 2 == 0 or toxic:
            labels.append((i, 1, int(toxic)))
    return data.documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


def test_toxicity_on_held_out_rows(spark):
    docs, labels, rows = _corpus(spark)
    model = toxicity.train(docs, labels)
    got = toxicity.score_documents(docs, model).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    right = sum(r.predicted == int(r.doc_id % 5 == 0) for r in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    # an unseen form of an expression
    import pyarrow as pa
    bad, good, none = model.scores(model.statistics(pa.array(["ban ter zhulken lo mi", "ban ter lo mi ras", None])))
    assert bad > 10 * good and good < 0.1 and none < 0.1
    kept = toxicity.reject_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if not r.predicted)


def test_toxicity_models_are_distributions():
    """Both conditionals of every context sum to at most one over counted events, and to one with what is left."""
    import pyarrow as pa
    codes, counts = toxicity.count_events(pa.array(["abab abc abd", "abab abe xyz", "abc abd"]), np.array([0, 1, 0]))
    assert counts.sum() and (counts >= 0).all()
    model = toxicity.estimate(codes, counts)
    assert np.isfinite(model.event_value).all() and np.isfinite(model.context_value).all()
    assert model.word_values(["abe"])[0] > 0 > model.word_values(["abc"])[0]


def test_toxicity_tables_keep_every_event(spark, monkeypatch):
    """Spark's tables hold each counted event and context by itself, with the values that memory gives."""
    import pyarrow as pa
    _, _, rows = _corpus(spark, 200)
    texts, toxic = [t for _, t, _ in rows], np.array([int(i % 5 == 0) for i, _, _ in rows])
    counted = toxicity.count_table(spark.createDataFrame(list(zip(texts, toxic.tolist())), "text string, toxic int"))
    codes, counts = toxicity.count_events(pa.array(texts), toxic)
    names = toxicity.event_names(codes).to_pylist()
    assert {r.event: (r.ordinary, r.toxic) for r in counted.collect()} == dict(zip(names, map(tuple, counts.tolist())))
    plain, tables = toxicity.estimate(codes, counts), toxicity.estimate_tables(counted)
    value = dict(zip(plain.events.tolist(), plain.event_value.tolist()))
    got = {r.event: r.value for r in tables.events.collect()}
    assert set(got) == set(names)
    assert all(got[e] == pytest.approx(value[h], abs=1e-4) for e, h in zip(names, toxicity.code_hash(codes).tolist()))
    assert sorted(r.value for r in tables.contexts.collect()) == pytest.approx(sorted(plain.context_value.tolist()), abs=1e-4)


def test_toxicity_of_chunks_is_that_of_texts(spark, tmp, monkeypatch):
    docs, labels, rows = _corpus(spark, 300)
    model = toxicity.train(docs, labels)
    import pyarrow as pa
    want = model.statistics(pa.array([t for _, t, _ in rows]))
    monkeypatch.setattr(toxicity, "CHUNK_ROWS", 7)
    got = {r.doc_id: r.statistic for r in toxicity.score_documents(data.on_disk(docs, f"{tmp}/chunks"), model).collect()}
    assert [got[i] for i, _, _ in rows] == pytest.approx(model.evidence(want).tolist())


def test_toxicity_looks_each_context_up_once(spark, tmp, monkeypatch):
    """A chunk sends a context once, with all that follows it, and gets the values that memory gives."""
    import pyarrow as pa
    _, _, rows = _corpus(spark, 200)
    odd = "\U00020000\U0002a6df \u6587\u5b57 \xfcn\xefc \U00020000\U0002a6e0"
    texts, toxic = [f"{t} {odd}" for _, t, _ in rows], np.array([int(i % 5 == 0) for i, _, _ in rows])
    seen = toxicity.count_table(spark.createDataFrame(list(zip(texts, toxic.tolist())), "text string, toxic int"))
    plain, tables = toxicity.estimate(*toxicity.count_events(pa.array(texts), toxic)), toxicity.estimate_tables(seen)
    sent = []
    valued = tables.valued
    monkeypatch.setattr(tables, "valued", lambda wanted: sent.append(wanted.cache()) or valued(sent[0]))
    new = ["banter \U00020000\U0002a6e1 zhulkerx", "qqqq zzzz", None, "", f"ban {odd}", *texts[:40]]
    docs = data.on_disk(data.documents(spark, [(i, t, "s") for i, t in enumerate(new)]).coalesce(1), f"{tmp}/contexts")
    docs, chunk = toxicity.with_chunks(docs)
    folder = toxicity.look_up(docs, chunk, tables)
    codes, h = toxicity.text_events(pa.array(new))
    names = Counter(r.context + chr(x) for r in sent[0].collect() for x in r.followers)
    assert names == Counter(toxicity.event_names(codes).to_pylist())
    assert sent[0].count() == len({n[:-1] for n in names}) < 0.7 * len(names)
    want = toxicity._find(plain.contexts, plain.context_value, toxicity.code_hash(codes[:, :-1]), np.float32(0))
    want = toxicity._find(plain.events, plain.event_value, h, want)
    got = toxicity._by_hash([spark.read.parquet(folder).select("context", "followers", "values").toArrow()])
    assert len(got[0]) == len(set(got[0].tolist()))
    assert toxicity._find(*got, h, np.float32(0)).tolist() == pytest.approx(want.tolist(), abs=1e-4)
    assert np.count_nonzero(want) > 100


@pytest.mark.parametrize("kind", ["phrases", "words"])
def test_toxicity_without_insults(spark, kind):
    """Toxic texts are known by phrases of ordinary words, or by ordinary words that they use more often."""
    rng = random.Random(5)
    plain = sorted({_word(rng) for _ in range(60)})
    rows, labels = [], []
    for i in range(900):
        toxic = int(i % 3 == 0)
        some = plain[:6] if toxic and kind == "words" else []
        words = [rng.choice(some if some and rng.random() < 0.2 else plain) for _ in range(120)]
        if kind == "phrases":  # both words stand in all texts, side by side in toxic ones
            for _ in range(6):
                words[rng.randrange(60):0] = ["solpe", "vinmi"] if toxic else ["solpe", rng.choice(plain), "vinmi"]
        rows.append((i, " ".join(words), "s"))
        labels.append((i, 1, toxic))
    model = toxicity.train(data.documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    held = [r for r in toxicity.score_documents(data.documents(spark, rows), model).collect() if r.held_out]
    assert sum(r.predicted == int(r.doc_id % 3 == 0) for r in held) >= 0.95 * len(held)


def test_toxicity_edge_rows(spark):
    docs, labels, _ = _corpus(spark, 300)
    model = toxicity.train(docs, labels)
    got = toxicity.score_documents(data.edge(spark), model).collect()
    assert len(got) == len(data.EDGE) and all(r.score is not None for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert next(r for r in got if r.doc_id is None).held_out == (zlib.crc32(b"") % 5 == 0)
    assert toxicity.score_documents(data.empty(spark), model).count() == 0
    none = toxicity.train(docs, labels.where("false"))
    assert {r.predicted for r in toxicity.score_documents(docs, none).collect()} == {0}
    odd = labels.selectExpr("doc_id", "quality", "cast(null AS int) AS toxic")
    assert toxicity.reject_toxic(docs, odd).count() == docs.count()


LINES = {"apache": "Licensed under the Apache License, Version 2.0.", "mit": "Released under the MIT License.",
         "gpl": "This work is licensed under the GNU General Public License, version 3.",
         "cc-by-nc": "Licensed under CC BY-NC 4.0.", "proprietary": "All rights reserved."}


def test_licence_families(spark, tmp):
    rng = random.Random(4)
    filler = lambda n: " ".join(_word(rng) for _ in range(n))
    rows, want = [], {}
    for i in range(200):
        names = sorted(LINES)[i % 7:i % 7 + 1 + (i % 3 == 0)] if i % 7 < 5 else []
        lines = [filler(30), *(LINES[n] for n in names), filler(200)]
        rows.append((i, "\n".join(lines), "s"))
        want[i] = ",".join(names) or "none"
    rows += [(500, None, "s"), (501, "", "s"), (502, filler(500) + " " + LINES["mit"] + " " + filler(300), "s"),
             (503, "You may redistribute under the terms of the Eclipse Public License 2.0 or the licence agreement.", "s"),
             (504, "mit der und gpl", "s"), (500, None, "s")]
    docs = data.on_disk(data.documents(spark, rows), f"{tmp}/docs")
    scan = licenses.train(docs)
    got = licenses.scan_documents(docs, scan).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in rows)
    by = {r.doc_id: r for r in got}
    wrong = [(i, by[i].license, w) for i, w in want.items() if by[i].license != w]
    assert len(wrong) <= 2, wrong
    assert by[500].license == by[501].license == "none" and by[504].license != "mit"
    assert by[502].license == "mit" and by[503].license in ("unknown", "none")
    assert licenses.scan_documents(data.empty(spark), scan).count() == 0


def test_notices_of_common_words_are_found(spark, tmp):
    """Words that a notice is made of may be common in the corpus."""
    rng = random.Random(9)
    common = "all rights reserved licensed license licence copyright public domain work apache version under released mit".split()
    filler = lambda n: " ".join(rng.choice(common) if rng.random() < 0.05 else _word(rng) for _ in range(n))
    rows = [(i, "\n".join(filler(25) for _ in range(12)), "s") for i in range(250)]
    rows += [(1000 + i, "\n".join([filler(25), line, filler(25)]), "s") for i, line in enumerate(LINES.values())]
    got = {r.doc_id: r.license for r in licenses.scan_documents(data.on_disk(data.documents(spark, rows), f"{tmp}/common")).collect()}
    assert [got[1000 + i] for i in range(len(LINES))] == list(LINES)
    assert sum(got[i] == "none" for i in range(250)) >= 240


@pytest.mark.parametrize("share", [0.002, 0.01, 0.03, 0.09])
def test_licences_are_found_however_common_they_are(spark, tmp, share):
    """Notice lines with differing names, as so many of all lines."""
    rng = random.Random(11)
    forms = {"mit": "Copyright {0} Firm{1}. Released under the MIT License.",
             "apache": "Firm{1} {0}: Licensed under the Apache License, Version 2.0.",
             "proprietary": "Copyright {0} Firm{1}. All rights reserved."}
    docs, lines = 600, 12
    rows, want = [], {}
    for i in range(docs):
        some = [" ".join(_word(rng) for _ in range(25)) for _ in range(lines)]
        if rng.random() < share * lines:
            want[i] = sorted(forms)[i % 3]
            some.insert(rng.randrange(lines), forms[want[i]].format(1990 + i % 30, i))
        rows.append((i, "\n".join(some), "s"))
    got = {r.doc_id: r.license for r in licenses.scan_documents(data.on_disk(data.documents(spark, rows), f"{tmp}/share")).collect()}
    assert want and {i: got[i] for i in want} == want
    assert sum(got[i] != "none" for i in got if i not in want) <= 0.02 * docs


def test_bound_drops_no_candidate(spark, tmp, monkeypatch):
    """Scoring all windows, and by hand, finds what scoring those within the bound finds."""
    rng = random.Random(12)
    notices = [t for texts in licenses.NOTICES.values() for t in texts]
    vocabulary = [w for t in notices for w in t.split()]
    rows = [(i, "\n".join(" ".join(rng.choice(vocabulary) if rng.random() < 0.3 else _word(rng) for _ in range(rng.randrange(0, 70)))
                          for _ in range(6)), "s") for i in range(120)]
    rows += [(1000 + i, t, "s") for i, t in enumerate(notices)]
    docs = data.on_disk(data.documents(spark, rows), f"{tmp}/bound")
    scan = licenses.train(docs)
    key = lambda df: {(r.doc_id, r.paragraph, r.start): list(r.p) for r in df.collect()}
    got = key(licenses.candidates(docs, scan))
    weights, start = scan.model.coefficientMatrix.toArray(), scan.model.interceptVector.toArray()
    place = {g: i for i, g in enumerate(scan.vocabulary.vocabulary)}
    want, windows = {}, licenses.windows_of(docs).collect()
    for r in windows:
        seen = {place[g] for g in {*r.words, *(f"{a} {b}" for a, b in zip(r.words, r.words[1:]))} if g in place}
        z = np.array([start[c] + weights[c, sorted(seen)].sum() for c in range(len(start))]) / scan.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        if r.words and p[0] < 1 - licenses.LIKELY:
            want[r.doc_id, r.paragraph, r.start] = p.tolist()
    assert set(got) == set(want) and len(want) > len(notices) // 2
    assert all(got[k][:len(want[k])] == pytest.approx(want[k], abs=1e-6) for k in want)
    assert licenses.windows_of(docs).where(licenses.bound(scan)).count() < len(windows)
    monkeypatch.setattr(licenses, "SLOTS_OF_GRAMS", 16)  # every slot shared
    assert set(key(licenses.candidates(docs, scan))) == set(want)


def _plain_top(rows, every=100, k=10):
    ok = [(n, i, [int(np.floor(1024 * float(x))) for x in e]) for n, (i, e) in enumerate(rows)
          if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for n, i, q in ok:
        if i is not None and i % every == 0:
            s = sorted((-sum(a * b for a, b in zip(q, e)), j is None, j or 0) for m, j, e in ok if m != n)[:k]
            out += [(i, r + 1, None if missing else j, -x) for r, (x, missing, j) in enumerate(s)]
    return sorted(out, key=str)


def _vectors(spark, rows):
    return spark.createDataFrame([(i, e, 0, 1.5) for i, e in rows], "vec_id long, embedding array<float>, label int, distance double")


@pytest.mark.parametrize("block", [pivots.BLOCK, 7])
def test_exact_top_k(spark, tmp, monkeypatch, block):
    monkeypatch.setattr(pivots, "BLOCK", block)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(6, 8))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 6] * 3 + rng.normal(size=8) * 0.2]) for i in range(1200)]
    rows += [(5000 + i, rows[3][1]) for i in range(60)]     # equal vectors
    rows += [(6000, None), (6100, [1.0, None] + [0.0] * 6), (6200, [float("nan")] * 8), (6300, [float("inf")] * 8),
             (None, rows[100][1]), (6400, [1.0, 2.0]), (100, rows[0][1]), (7000, [])]
    vectors = data.on_disk(_vectors(spark, rows), f"{tmp}/v")
    got = pivots.top_k(vectors).collect()
    assert sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in got), key=str) == _plain_top(rows)


def test_few_and_no_vectors(spark, tmp):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])]
    got = pivots.top_k(data.on_disk(_vectors(spark, rows), f"{tmp}/v")).collect()
    assert [(r.rank, r.vec_id) for r in sorted(got, key=lambda r: r.rank)] == [(1, 1), (2, 2)]
    assert pivots.top_k(data.on_disk(_vectors(spark, rows[:1]), f"{tmp}/one")).count() == 0
    assert pivots.top_k(data.on_disk(_vectors(spark, rows).where("false"), f"{tmp}/none")).count() == 0


def test_pruning_skips_far_annuli(spark, tmp, monkeypatch):
    """Vectors of one cluster need no annulus of the far ones."""
    monkeypatch.setattr(pivots, "BLOCK", 20)
    rng = np.random.default_rng(7)
    rows = [(i, ((np.eye(4)[i % 4]) * (10 if i % 4 else 1) + rng.normal(size=4) * 0.01).tolist()) for i in range(800)]
    seen = []
    build = pivots.build
    monkeypatch.setattr(pivots, "build", lambda *a: seen.append(build(*a)) or seen[0])
    stage = pivots.stage
    staged = {}
    monkeypatch.setattr(pivots, "stage", lambda df, name: staged.setdefault(name, stage(df, name)))
    got = pivots.top_k(data.on_disk(_vectors(spark, rows), f"{tmp}/v"), every=7).collect()
    assert sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in got), key=str) == \
        _plain_top([(i, [float(np.float32(x)) for x in e]) for i, e in rows], every=7)
    groups, annuli = (seen[0].where(f"kind = '{k}'").count() for k in ("queries", "annulus"))
    assert 0 < staged["pivot-pairs"].count() <= groups * annuli


def _plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if share * weight[s] > 2 * sizes[s]}
        if not over:
            target |= {s: share * weight[s] for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    return target


def _mixture_rows():
    rng = random.Random(8)
    rows = [(i, " ".join(_word(rng) for _ in range(rng.randrange(0, 60))),
             rng.choice(["a", "a", "a", "b", "c", "é", "Z", None, "d"])) for i in range(2500)]
    return rows + [(None, "no number here", "a"), (9000, None, "b"), (9001, "x\x0by\x0cz  w", "lone"), (9002, "same row", "c"),
                   (9002, "same row", "c")]


def test_mixture_meets_its_targets(spark, tmp):
    rows = _mixture_rows()
    docs = data.on_disk(data.documents(spark, rows), f"{tmp}/docs")
    got = mixing.mixed_sizes(docs).collect()
    sizes = Counter()
    n_words = lambda t: len((t or "").encode().split())
    for _, t, s in rows:
        sizes[s] += n_words(t)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, n_words(t)) for i, t, _ in rows)
    target = _plain_targets(sizes)
    source = {i: s for i, _, s in rows}
    taken = Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(60, 0.01 * target[s]) or s == "lone"
    again = mixing.mixed_sizes(docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    copies = Counter(r.doc_id for r in mixed.collect())
    for r in got:
        if r.size and r.doc_id != 9002:
            assert copies[r.doc_id] == r.taken // r.size


def test_splitting_tree_deals_every_draw_once(spark, tmp):
    docs = data.on_disk(data.documents(spark, _mixture_rows()), f"{tmp}/docs")
    for shards in (1, 5, 8):
        _, _, dealt = mixing.plan(docs, shards)
        rows = dealt.collect()
        assert max(Counter((r.source, r.block, r.copy) for r in rows).values()) == 1
        count = Counter(r.shard for r in rows)
        assert set(count) == set(range(shards)) and max(count.values()) - min(count.values()) <= shards
        if shards == 8:  # each shard holds about its part of a large source
            own = Counter(r.shard for r in rows if r.source == "a")
            assert min(own.values()) > 0.6 * sum(own.values()) / shards


def test_shard_copies_come_through_the_tree(spark, tmp):
    docs = data.on_disk(data.documents(spark, _mixture_rows()), f"{tmp}/docs")
    eight, one = ({r.doc_id: r for r in mixing.mixed_sizes(docs, n).collect() if r.doc_id is not None} for n in (8, 1))
    per_shard = Counter()
    for doc_id, r in eight.items():
        held = [int(x) for x in r.shard_copies.split(",")]
        assert len(held) == 8 and r.taken == r.size * sum(held) and sum(held) == int(one[doc_id].shard_copies)
        per_shard += Counter({i: n for i, n in enumerate(held)})
    assert min(per_shard.values()) > 0.7 * max(per_shard.values())


def test_mixture_comes_near_with_few_long_documents(spark, tmp):
    rng = random.Random(3)
    rows = [(60 * s + i, "w " * int(20 * rng.paretovariate(0.8)), f"s{s}") for s in range(4) for i in range(60)]
    docs = data.on_disk(data.documents(spark, rows), f"{tmp}/docs")
    taken, target = Counter(), {}
    source = {i: s for i, _, s in rows}
    for r in mixing.mixed_sizes(docs).collect():
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert r.taken <= 2 * r.size
    # no undrawn block fits in what is left, and no single exchange comes nearer
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] for s in target), (taken, target)


def test_mixture_edges(spark, tmp):
    assert mixing.mixed_sizes(data.empty(spark)).count() == 0 and mixing.mix(data.empty(spark)).count() == 0
    none = data.on_disk(data.documents(spark, [(1, None, "a"), (2, "", "b")]), f"{tmp}/none")
    assert {(r.size, r.taken, r.target) for r in mixing.mixed_sizes(none).collect()} == {(0, 0, 0.0)}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_against_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data.SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, data.SF)
    got = Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())
    cur = con.execute(queries.ORACLES[name])
    cols = [d[0] for d in cur.description]
    want = Counter(tuple(row[cols.index(c)] for c in sorted(cols)) for row in cur.fetchall())
    assert sorted(cols) == sorted(df.columns) and got == want


def test_all_queries_and_the_pipeline_are_registered():
    import __spark_entry__ as E
    names = E.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names


def test_native_queries_run_no_python(spark):
    for name in ("op1_license_scan", "op10_hypergeometric_mixing"):
        plan = queries.QUERIES[name](spark, data.SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_pipeline_stages(spark, tmp):
    docs = spark.read.parquet(f"{data.SF}/documents.parquet")
    first = docs.count()
    for i, (name, apply) in enumerate(corpus_pipeline.STAGES):
        out = data.on_disk(apply(spark, docs, data.SF), f"{tmp}/{i}")
        if i < 3:
            assert out.columns == docs.columns
            keys = {r.doc_id for r in out.select("doc_id").collect()}
            assert keys <= {r.doc_id for r in docs.select("doc_id").collect()}
        else:
            whole = {}
            for r in out.collect():
                whole[r.doc_id] = whole.get(r.doc_id, 0) + r.length
            copies = Counter(r.doc_id for r in docs.select("doc_id").collect())
            tokens = {r.doc_id: r.doc_tokens for r in out.collect()}
            assert whole == {i: tokens[i] * n for i, n in copies.items()}
        docs = out
    assert first > 0
    assert corpus_pipeline.run(spark, data.SF).columns == out.columns


def test_toxicity_counts_take_labels_without_moving_texts(spark, tmp, monkeypatch):
    """Labels reach the rows of a chunk by their places: no text is exchanged, and repeated and unlabelled rows count as in a join."""
    monkeypatch.setattr(toxicity, "CHUNK_ROWS", 3)
    monkeypatch.setattr(toxicity, "release", lambda *tables: None)
    rows = [(i % 17 if i % 9 else None, f"text {i} of {i % 4}" if i % 5 else None, "s") for i in range(60)]
    docs = data.on_disk(data.documents(spark, rows), f"{tmp}/docs")
    labels = spark.createDataFrame([(i, 1, [0, 1, None][i % 3]) for i in range(17) if i != 4] + [(5, 1, 1), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    seen = []
    count = toxicity.count_table
    monkeypatch.setattr(toxicity, "count_table", lambda texts, *how: seen.append((texts, count(texts, *how))) or seen[-1][1])
    toxicity.count_models(docs, labels)
    monkeypatch.undo()
    assert "Exchange" not in seen[0][0]._jdf.queryExecution().executedPlan().toString()
    joined = (docs.where(~toxicity.fold(F.col("doc_id")).isin(0, toxicity.CALIBRATION_FOLD))
              .join(toxicity.marked(labels), "doc_id").select("text", "toxic"))
    want = {r.event: (r.ordinary, r.toxic) for r in toxicity.count_table(joined).collect()}
    assert want and {r.event: (r.ordinary, r.toxic) for r in seen[0][1].collect()} == want
