"""Conversation trie, filter audit, rule ensemble, and the byte pass below them."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from squall.llm import audit, bytepass, rules, trie
from tests.llm import data

WORD = re.compile(r"[^\x20\x09-\x0D]+")
HOSTILE = ["", None, " ", "a", "a a", "Aa  B#\n\n\tÜ文 文 ü", "x" * 200 + " " + "x" * 200 + " " + "x" * 199 + "y", "a\n\na\nb\n", "\n", "end\n",
           "no-break space em", "\x1c\x85 1.2, 3|4 $", "́ ́a", "🙂🙂 🙂"]


# ---- byte pass ---------------------------------------------------------------

def test_byte_pass_counts_like_plain_python():
    rng = random.Random(1)
    texts = HOSTILE + ["".join(rng.choice("aB #\n\té文🙂|9.") for _ in range(rng.randrange(80))) for _ in range(300)]
    for some in (texts, texts[3:9], [], [None], ["", ""]):
        got = audit.count_texts(pa.array(some, pa.string()))
        want = [(len(w := WORD.findall(t or "")), len(set(w)), len(re.findall("[A-Z]", t or "")), len(t or ""),
                 len(re.findall(r"[#$%&*|]", t or ""))) for t in some]
        assert [tuple(r) for r in got.tolist()] == want
        found = bytepass.run(pa.array(some, pa.string()))
        start, end = bytepass.lines(found)
        lines = [found.data[a:b].tobytes().decode() for a, b in zip(start, end)]
        assert lines == [line for t in some for line in (t or "").split("\n") if line]
    sliced = pa.array(texts, pa.string()).slice(5, 20)
    assert [r[0] for r in audit.count_texts(sliced).tolist()] == [len(WORD.findall(t or "")) for t in texts[5:25]]


def test_hash_table_compares_bytes(monkeypatch):
    """With one hash for all spans the table still tells them apart."""
    texts = pa.array(["aa bb aa cc " + "l" * 90 + " " + "l" * 89 + "m", "bb aa"])
    found = bytepass.run(texts)
    text = found.text_of(found.start)
    monkeypatch.setattr(bytepass, "span_hashes", lambda data, start, size, seed: np.zeros(len(start), np.uint64))
    owner = bytepass.first_equal(found.data, found.start, found.end, text)
    assert len(set(owner[text == 0].tolist())) == 5 and len(set(owner[text == 1].tolist())) == 2
    assert owner[0] == owner[2]


# ---- filter audit --------------------------------------------------------------

def _plain_audit(rows, labels):
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in (0, 1))
    smallest = {}
    for i, t, _ in rows:
        if i is not None:
            smallest[t or ""] = min(smallest.get(t or "", i), i)
    parts = defaultdict(list)
    for i, t, lang in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = {c for c, f in zip("ABCDE", (len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                                              re.search(r"[#$%&*|]", t), i is not None and i > smallest[t])) if f}
        parts[lang or ""].append((fails, i in good, i in toxic))
    out = {}
    for part, docs in parts.items():
        removed_by = Counter()
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                removed_by[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(f in d[0] for d in docs) - len(gone),
                                                   sum(d[0] == {f} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(removed_by[order[step - 1]])
    return out


def _audited(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
            for r in df.collect()}


def test_audit_against_every_order_played_out(spark):
    rng = random.Random(4)
    pool = [" ".join(rng.choice(["Ab", "cd", "e", "F#", "Ü", *map(str, range(150))]) for _ in range(rng.randrange(0, 220))) for _ in range(25)]
    rows = [(i if rng.random() < 0.95 else None, rng.choice([*pool, None, "", "same"]), rng.choice(["en", "de", None, ""])) for i in range(300)]
    rows += rows[:7] + [(rows[0][0], "another text of one id", "en")]
    labels = [(rng.randrange(320), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(200)] + [(None, 1, 1)]
    docs = spark.createDataFrame([(i, t, lang, "x", "y") for i, t, lang in rows],
                                 "doc_id long, text string, lang string, digest string, failed string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = _audited(audit.audit(docs, marks))
    want = _plain_audit(rows, labels)
    assert len(got) == 3 * 120 * 5 and got == want


def test_audit_edges(spark):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(data.empty(spark), marks).count() == 0
    rows = [(i, t, "en") for i, t, _ in data.EDGE]
    assert _audited(audit.audit(data.edge(spark), marks)) == _plain_audit(rows, [])
    # other filters than the five
    few = _audited(audit.audit(data.edge(spark), marks, {"X": "words = 0", "Y": "code_points > 1000"}))
    assert {o for _, o, _ in few} == {"".join(p) for p in permutations("XYE")}
    assert few["en", "XYE", 1][:2] == [len(rows) - 3, 3]


# ---- conversation trie -----------------------------------------------------------

def _plain_trie(rows, every=20, most=4):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), role, text))
    own = {c: [(r, t) for _, r, t in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    rebuilt = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - (abs(c) % every) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(own.get(base, [])[:h] + seq[h:])
    members = defaultdict(list)
    for c, seq in sorted(rebuilt.items()):
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)

    def below(p):
        yield p
        for q in children.get(p, ()):
            yield from below(q)

    out = []
    for p, m in members.items():
        sub = list(below(p))
        ends = ",".join(str(c) for c in m if len(rebuilt[c]) == len(p))
        out.append((m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(children.get(p, ())),
                    sum(not children.get(q) for q in sub), sum((len(members[q]) - 1) * len(WORD.findall(q[-1][1])) for q in sub if q),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


SCHEMA = "conv_id long, turn long, role string, text string, ids string, words string, shard string, h int, base string"


def _conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", 1, "b") for r in rows], SCHEMA)


@pytest.mark.parametrize("shards", [1, 2, 7])
def test_trie_against_plain_python(spark, shards):
    rng = random.Random(shards)
    rows = []
    for c in [*range(0, 90), -3, -20, -21, 400, 403]:
        if c == 40:
            continue  # a base that does not exist
        n = rng.choice([1, 2, 3, 4, 6, 20, 40]) if c % 7 else 1
        rows += [(c, t, rng.choice(["user", None, "bot"]), rng.choice(["a b", "a b", "c", "", None])) for t in range(n)]
    # a third of all conversations are alike, and longer than a band
    rows += [(1000 + 20 * i, t, "user", f"same {t % 3}") for i in range(50) for t in range(20)]
    rows += [(None, 1, "user", "nobody"), (500, None, "user", "first"), (500, 0, "user", "then"), (501, 1, "u", "tie"), (501, 1, "u", "tie")]
    got = trie.conversation_trie(_conversations(spark, rows), shards=shards).collect()
    assert Counter(map(tuple, got)) == _plain_trie(rows)


def test_trie_edges(spark):
    none = _conversations(spark, [(1, 1, "a", "b")]).where("false")
    assert trie.conversation_trie(none).count() == 0
    assert trie.conversation_trie(_conversations(spark, [(None, 1, "a", "b")])).count() == 0
    # 1 % 20 and no base: its only turn is cut off, so it is a member of the root alone
    gone = [c for c in range(1, 60) if zlib.crc32(str(c).encode()) % 4 >= 1 and c % 20][:3]
    rows = [(c, 0, "user", "lost") for c in gone]
    got = list(map(tuple, trie.conversation_trie(_conversations(spark, rows)).collect()))
    assert Counter(got) == _plain_trie(rows) and len(got) == 1 and got[0][1] == 0
    long = [(0, 0, "user", data.LONG), (1, 0, "user", data.LONG), (1, 1, None, None)]
    assert Counter(map(tuple, trie.conversation_trie(_conversations(spark, long)).collect())) == _plain_trie(long)


def test_trie_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(trie, "FEW_NODES", 0)
    rows = [(c, t, "user", f"{(c >> t) % 2}") for c in range(40) for t in range(5)]
    assert Counter(map(tuple, trie.conversation_trie(_conversations(spark, rows), shards=5).collect())) == _plain_trie(rows)


# ---- rule ensemble -----------------------------------------------------------------

def _quality_corpus(n=900):
    rng = random.Random(8)
    names = [f"w{rng.randrange(10 ** 6)}" for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(names) for _ in range(rng.randrange(30, 120))]
        bad = i % 6 == 0
        if bad and i % 18:
            words = [w for w in words[:20] for _ in range(4)]
        elif bad:
            words = [w + "###" for w in words]
        rows.append((i, " ".join(words), "s"))
        if i % 5:
            labels.append((i, int(not bad), 0))
    return rows, labels


def test_rules_on_held_out_rows(spark):
    rows, labels = _quality_corpus()
    docs = data.documents(spark, rows)
    model = rules.train(docs, spark.createDataFrame([*labels, (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int"))
    assert model.rules and all(w != 0 for w in model.weights)
    got = rules.score_documents(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r.predicted == int(r.doc_id % 6 != 0) for r in held) >= 0.98 * len(held)


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    rows, labels = _quality_corpus(240)
    docs = data.documents(spark, rows)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in labels]
    a, b = (rules.train(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, turned))
    assert a.rules == b.rules and a.weights == pytest.approx(b.weights)


def test_compiled_rules_are_the_paths(spark):
    """Every path of a forest, by hand and as a column."""
    printed = """RandomForestClassificationModel: uid=x, numTrees=2
  Tree 0 (weight 1.0):
    If (feature 0 <= 5.0)
     If (feature 1 <= 0.5)
      Predict: 0.0
     Else (feature 1 > 0.5)
      Predict: 1.0
    Else (feature 0 > 5.0)
     If (feature 0 <= 9.0)
      Predict: 0.0
     Else (feature 0 > 9.0)
      Predict: 1.0
  Tree 1 (weight 1.0):
    Predict: 0.0
"""
    got = rules.tree_rules(printed, ("x", "y"))
    inf = float("inf")
    assert [r.terms for r in got] == [(("x", -inf, 5.0),), (("x", -inf, 5.0), ("y", -inf, 0.5)), (("x", -inf, 5.0), ("y", 0.5, inf)),
                                      (("x", 5.0, inf),), (("x", 5.0, 9.0),), (("x", 9.0, inf),)]
    points = [(x, y) for x in (0.0, 5.0, 7.0, 9.0, 12.0) for y in (0.0, 0.5, 1.0)]
    frame = spark.createDataFrame(points, "x double, y double").select("x", "y", *(r.column().alias(f"r{i}") for i, r in enumerate(got)))
    for row in frame.collect():
        at = {"x": row.x, "y": row.y}
        assert list(row[2:]) == [all(low < at[f] <= high for f, low, high in r.terms) for r in got]


def test_statistics_of_awkward_texts():
    got = rules.measure_texts(pa.array(HOSTILE, pa.string()))
    assert got.shape == (len(HOSTILE), len(rules.STATISTICS)) and np.isfinite(got).all()
    at = {s: i for i, s in enumerate(rules.STATISTICS)}
    assert not got[0].any() and not got[1].any()
    one = rules.measure_texts(pa.array(["go go go Stop#\nend. end."]))[0]
    assert (one[at["words"]], one[at["longest_repeat"]], one[at["lines"]]) == (6, 2, 2)
    assert one[at["repeat_share"]] == pytest.approx(3 / 6) and one[at["distinct_share"]] == pytest.approx(3 / 6)
    assert one[at["top_word_share"]] == pytest.approx(3 / 6) and one[at["symbol_words"]] == pytest.approx(1 / 6)


def test_rules_edges(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = rules.train(data.edge(spark), none)
    got = rules.score_documents(data.edge(spark), model).collect()
    assert len(got) == len(data.EDGE) and {r.score for r in got} == {0.5} and {r.predicted for r in got} == {1}
    only_bad = spark.createDataFrame([(i, 0, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in rules.score_documents(data.edge(spark), rules.train(data.edge(spark), only_bad)).collect()} == {0}
    assert rules.score_documents(data.empty(spark), model).count() == 0
    assert rules.train(data.empty(spark), none).rules == []
