"""N-gram join, decontamination, line dedup, components: brute force and edge cases."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from kickstar.llm import decontaminate, line_dedup, ngram_join
from kickstar.llm.components import components
from tests.conftest import rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute_near(data, threshold=(4, 5)):
    sets = []
    for _, t in data:
        w = words(t)
        k = min(5, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    p, q = threshold
    linked = [[bool(a and b) and i != j and q * len(a & b) >= p * len(a | b) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    root = list(range(len(sets)))
    for i in range(len(sets)):
        todo, seen = [i], {i}
        while todo:
            for j in np.flatnonzero(linked[todo.pop()]):
                if int(j) not in seen:
                    seen.add(int(j))
                    todo.append(int(j))
        root[i] = min((data[j][0] for j in seen if data[j][0] is not None), default=None)
    return sorted(((d, root[i], sum(linked[i])) for i, (d, _) in enumerate(data)), key=repr)


def near_data(seed=3, families=6, size=14):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(vocab) for _ in range(30)]
    data, n = [], 0
    for f in range(families):
        base = [rnd.choice(vocab) for _ in range(rnd.choice((8, 60, 200)))]
        for c in range(size):
            t = list(base)
            for _ in range(rnd.randrange(0, 1 + len(base) // 40)):
                t[rnd.randrange(len(t))] = rnd.choice(vocab)
            data.append((n, " ".join(t) if c % 5 else " ".join(base)))
            n += 1
    for _ in range(60):
        data.append((n, " ".join(rnd.choice(vocab) for _ in range(40)) + " " + " ".join(passage)))
        n += 1
    return data


@pytest.mark.parametrize("limits", [{}, {"limit": 4, "block": 5}, {"limit": 8, "block_tokens": 500}])
def test_near_duplicates(spark, limits):
    data = near_data() + [(900, None), (901, ""), (902, "one Two three"), (903, "ONE two, three!"), (904, "one two"), (None, "one two three"),
                          (905, "x y z " * 20_000), (906, "x y z " * 20_000), (906, "x y z " * 20_000), (906, "other text of this id here")]
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 AS class_id", "2 AS sig", "3 AS th")
    small = [(d, t if len(t or "") < 10_000 else "x y z " * 30) for d, t in data]
    assert rows(ngram_join.near_duplicates(df, **limits)) == brute_near(small)


def test_near_duplicates_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.near_duplicates(none).count() == 0 and ngram_join.keep_one(none).count() == 0


def test_keep_one(spark):
    data = near_data(5, 4, 8) + [(None, "a b c"), (None, "a b c"), (700, None), (700, None), (701, "a b c d"), (701, "a b c d")]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("more", F.lit(1))
    got = rows(ngram_join.keep_one(df), "doc_id")
    classes = {c for d, c, _ in brute_near(data) if d is not None and d not in (700, 701)}
    assert got == sorted([(c,) for c in classes] + [(None,), (700,), (700,), (701,)], key=repr)


def test_runs_meet_recall():
    assert ngram_join.runs_for(0.999, 1) == 7 and ngram_join.runs_for(0.999, 3) == 15
    assert 190 < ngram_join.sketch_floor(0.8) < 230


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(100, i) for i in range(101, 180)] + [(180, 179), (7, 7), (None, 3), (200, 201), (201, 200)]
    rnd.shuffle(edges)
    got = dict(rows(components(spark.createDataFrame(edges, "a int, b int"))))
    assert {v: r for v, r in got.items() if v < 100} == {v: v // 20 * 20 for v in range(60)}
    assert {r for v, r in got.items() if 100 <= v <= 180} == {100} and got[201] == got[200] == 200
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0


def brute_contaminated(docs, items, window=13):
    out = []
    wins = {}
    for i, t in items:
        w = words(t)
        m = min(window, len(w))
        for k in range(len(w) - m + 1 if w else 0):
            wins.setdefault(tuple(w[k:k + m]), set()).add("" if i is None else str(i))
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for m in {len(x) for x in wins}:
            for k in range(len(w) - m + 1):
                ids = wins.get(tuple(w[k:k + m]))
                if ids:
                    hit |= set(range(k, k + m))
                    found |= ids
        out.append((d, len(w), len(hit), len(found), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def test_decontamination(spark):
    rnd = random.Random(9)
    vocab = [f"v{i}" for i in range(30)]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    common = text(13)
    items = [(i, text(n)) for i, n in enumerate((13, 20, 40, 12, 4, 2, 6))] + [(10, common), (11, common), (12, common + " " + text(9)),
                                                                               (12, text(15)), (13, None), (14, " .. "), (None, "lonely item words"), (15, "É v1 é")]
    docs = [(i, text(rnd.randrange(5, 80))) for i in range(40)]
    docs += [(100 + i, text(rnd.randrange(0, 300)) + " " + t + ". " + text(7)) for i, (_, t) in enumerate(items) if t]
    docs += [(200 + i, common.upper()) for i in range(50)] + [(300, None), (301, ""), (None, common), (302, common), (302, common), (302, "v1"),
                                                              (303, (text(50) + "\n") * 600 + common + " " + common)]
    docs += [(304, "x É v1 É"), (305, "É V1 é")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS N_HIT", "2 AS start", "'i' AS items", "4 AS h")
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("win", F.lit(1))
    out = decontaminate.contaminated(df, bench)
    assert rows(out, "doc_id", "n_words", "n_hit", "n_items", "items", "contaminated") == brute_contaminated(docs, items)
    assert "Python" not in out._jdf.queryExecution().toString()


def test_decontamination_empty(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert rows(decontaminate.contaminated(docs, none), "n_words", "n_hit", "contaminated") == [(3, 0, False)]
    assert decontaminate.contaminated(docs.limit(0), none).count() == 0


def brute_runs(docs, min_words):
    """{(id, text): (lines, removed lines, text left)} from the definition: every pair of equal
    lines is extended to its maximal run, and the later place of a long run goes."""
    own, at = {}, []
    for key in sorted(set(docs), key=lambda x: (x[0] is not None, x[0] or 0)):
        lines = enumerate((key[1] or "").split("\n"))
        own[key] = [(i, x, len(re.findall(r"[^\x20\x09-\x0D]+", x))) for i, x in lines if re.search(r"[^\x20\x09-\x0D]", x)]
        at += [(key, s) for s in range(len(own[key]))]
    line = lambda d, s: own[d][s][1] if 0 <= s < len(own[d]) else None
    cut = {d: set() for d in own}
    places = {}
    for d, s in at:
        places.setdefault(line(d, s), []).append((d, s))
    for same in places.values():
        for k, (d, s) in enumerate(same):
            for e, r in same[k + 1:]:
                if line(d, s - 1) is not None and line(d, s - 1) == line(e, r - 1):
                    continue                        # the run begins further up
                n = 1
                while line(d, s + n) is not None and line(d, s + n) == line(e, r + n):
                    n += 1
                if sum(w for _, _, w in own[e][r:r + n]) >= min_words:
                    cut[e] |= {i for i, _, _ in own[e][r:r + n]}
    return {(d, t): (len((t or "").split("\n")), len(cut[d, t]), None if t is None else
                     "\n".join(x for i, x in enumerate(t.split("\n")) if i not in cut[d, t])) for d, t in own}


@pytest.mark.parametrize("min_words", [1, 6, 50])
def test_line_dedup(spark, min_words):
    rnd = random.Random(min_words)
    pool = [" ".join(f"l{i}{k}" for k in range(rnd.randrange(1, 12))) for i in range(25)]
    docs = []
    for i in range(60):
        lines = [rnd.choice(pool) if rnd.random() < 0.8 else f"unique line {i} {rnd.random()}" for _ in range(rnd.randrange(0, 40))]
        if i % 3 == 0:
            lines[2:2] = pool[:18]
        docs.append((i, "\n".join(rnd.choice(("", " ")) if rnd.random() < 0.1 else x for x in lines)))
    docs += [(100 + i, docs[0][1]) for i in range(5)] + [(200, None), (201, ""), (202, "\n\n"), (None, docs[3][1]), (203, "same words\n" * 200),
                                                        (300, docs[0][1]), (300, docs[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n_lines", "2 AS seq", "3 AS doc", "4 AS `rank`")
    want = brute_runs(docs, min_words)
    got = rows(line_dedup.dedup_lines(df, min_words), "doc_id", "n_lines", "n_removed", "text")
    assert got == sorted(((d, *want[d, t]) for d, t in docs), key=repr)
    assert sum(r[2] for r in got) > 0


def test_line_dedup_removes_maximal_runs(spark):
    rnd = random.Random(9)
    made = lambda name, sizes: [" ".join(f"{name}{i}x{k}" for k in range(n)) for i, n in enumerate(sizes)]
    runs = [made("a", [60, 5, 5, 5]), made("b", [20, 20, 20, 3]), made("c", [1] * 70), made("d", [3, 60]), made("e", [49, 1, 48]), made("f", [24, 25])]
    docs = [(10 * n, "\n".join([f"first {n}", *run, f"end {n}"])) for n, run in enumerate(runs)]
    docs += [(10 * n + 1, "\n".join([f"own {n}", *run, "", f"last {n}"])) for n, run in enumerate(runs)]
    docs += [(10 * n + 2, "\n".join(run[:-1])) for n, run in enumerate(runs)] + [(500, "seven words that come again and again\n" * 30)]
    pool = made("p", [rnd.randrange(1, 40) for _ in range(6)])
    docs += [(1000 + i, "\n".join(rnd.choice(pool) for _ in range(12))) for i in range(25)]
    got = {(r.doc_id): (r.n_lines, r.n_removed, r.text) for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {d: x for (d, _), x in brute_runs(docs, 50).items()}
    assert [got[d][1] for d in (1, 11, 21, 31, 41, 51)] == [4, 4, 70, 2, 3, 0]


def test_line_dedup_empty(spark):
    out = line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string"))
    assert out.count() == 0 and "Python" not in out._jdf.queryExecution().toString()
