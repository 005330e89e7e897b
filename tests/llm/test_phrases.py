"""Collocations: brute force, edge cases, collisions of fingerprints, long texts."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kickstar.llm import collocations
from tests.conftest import rows

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(docs, top, min_count):
    words, f = Counter(), Counter()
    for _, t, lang in docs:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")):
            w = re.findall(r"[^ \t]+", piece)
            words[lang] += len(w)
            for n in range(1, 5):
                f.update((lang, tuple(w[i:i + n])) for i in range(len(w) - n + 1))
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    out = []
    for (lang, w), a in cand.items():
        cuts = [(2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        if any(x == lang and len(v) > len(w) and 100 * b >= 80 * a and any(v[i:i + len(w)] == w for i in range(len(v)))
               for (x, v), b in cand.items()):
            continue
        out.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    ranked = []
    for lang in words:
        own = sorted(x for x in out if x[0] == lang)[:top]
        ranked += [(lang, i + 1, p.decode(), -a, lo, r, words[lang], -s) for i, (_, s, a, p, lo, r) in enumerate(own)]
    return sorted(ranked, key=repr)


def made(seed=1):
    rnd = random.Random(seed)
    vocab = ["a", "b", "É", "été", "X", "y", "zz", " q", "new", "York", "hot", "dog"]
    docs = []
    for i in range(150):
        parts = []
        for _ in range(rnd.randrange(0, 30)):
            parts.append(rnd.choice(["New York city hall", "hot  dog", "HOT\tdog stand", " ".join(rnd.choice(vocab) for _ in range(rnd.randrange(1, 6)))]))
            parts.append(rnd.choice([" ", ". ", "\n", "\x0b", ", ", "!", "  "]))
        docs.append((i, "".join(parts), rnd.choice(["en", "de", "en", None])))
    docs += [(500 + i, docs[3][1], "en") for i in range(40)] + [(600, None, "en"), (601, "", "fr"), (602, "...", None), (None, docs[4][1], "en")]
    docs += [(700, docs[5][1], "en"), (700, docs[5][1], "en"), (700, docs[6][1], "und"), (701, "same word " * 3000, "es"), (702, "ab" * 30_000 + " end", "es")]
    return docs


@pytest.mark.parametrize("top, min_count", [(2000, 30), (7, 5), (2000, 2)])
def test_collocations(spark, top, min_count):
    docs = made(top)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").selectExpr("*", "1 AS n", "2 AS fp", "3 AS body", "4 AS th", "5 AS `rank`")
    assert rows(collocations.collocations(df.repartition(7), top, min_count), *COLUMNS) == brute(docs, top, min_count)


def test_weak_fingerprints(spark, monkeypatch):
    """Fingerprints of six bits, a filter that lets all pass and small blocks change nothing."""
    real = collocations.Runs.fingerprints
    monkeypatch.setattr(collocations.Runs, "fingerprints", lambda self, n: (lambda h, ok: (h >> np.uint64(58) << np.uint64(58), ok))(*real(self, n)))
    monkeypatch.setattr(collocations, "CHECK_BITS", 2)
    monkeypatch.setattr(collocations, "BLOCK", 300)
    monkeypatch.setattr(collocations, "KEPT", 40)
    docs = made(5)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    assert rows(collocations.collocations(df, 50, 20), *COLUMNS) == brute(docs, 50, 20)


def test_filter_is_bounded_and_complete(spark):
    rnd = random.Random(3)
    fps = [rnd.randrange(-2**63, 2**63) for _ in range(500)] + [0, -1, 2**63 - 1, -2**63]
    df = spark.createDataFrame([(x, 30) for x in fps] + [(None, 30)], "fp long, n long")
    bits = collocations._filter(df)
    assert len(bits) == 2**23
    slots = {(x % 2**64) >> 38 for x in fps}
    assert {i * 8 + j for i, b in enumerate(bits) if b for j in range(8) if b >> j & 1} == slots
    assert not any(collocations._filter(df.filter("n < 0")))


def test_packed_numbers():
    values = np.array([0, 1, 2**63 - 1, 77], np.int64)
    assert (collocations._unpacked(collocations._packed(values), np.int64) == values).all()
    assert len(collocations._unpacked(b"", np.uint64)) == 0


def test_parts_end_at_breaks():
    text = b"one two\nthree four five\n" + b"x" * 50 + b"\ny z"
    for size in (1, 5, 10, 30, 200):
        parts = list(collocations._parts(text, size))
        assert b"".join(parts) == text and all(p.endswith(b"\n") for p in parts[:-1])


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string").withColumn("more", F.lit(1))
    assert collocations.collocations(none).count() == 0
