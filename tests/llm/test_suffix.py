"""Suffix-array removal of repeated bytes: brute force, edge cases, pieces and boundaries."""

import hashlib
import random

import numpy as np
import pytest

from kickstar.llm import queries, rolling, suffix_dedup
from tests.conftest import SF_SMALL, rows


def brute(docs, length):
    """{(id, text): (kept, number of bytes, removed, runs)} from all strings of ``length`` bytes."""
    seen, out = set(), {}
    key = lambda x: (x[0] is not None, x[0] or 0)  # noqa: E731  ids differ where texts differ
    for d, t in sorted(set(docs), key=key):
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                gone[p:p + length] = True
            seen.add(w)
        runs = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(b) else 0
        out[d, t] = (bytes(x for x, g in zip(b, gone) if not g), len(b), int(gone.sum()), runs)
    return out


def made(seed, alphabet="abcdé \n"):
    rnd = random.Random(seed)
    text = lambda n: "".join(rnd.choice(alphabet) for _ in range(n))
    passages = [text(n) for n in (12, 20, 25, 60, 300)]
    docs = []
    for i in range(80):
        parts = [rnd.choice(passages) if rnd.random() < 0.5 else text(rnd.randrange(0, 40)) for _ in range(rnd.randrange(0, 8))]
        docs.append((i * 3, "".join(parts)))
    docs += [(1000 + i, docs[5][1]) for i in range(6)] + [(1100 + i, docs[7][1][:i * 9] + "x" + docs[7][1][i * 9:]) for i in range(6)]
    docs += [(2000, None), (2001, ""), (None, docs[9][1]), (2003, "ab" * 400), (2004, "a" * 500 + text(30)), (2005, text(19)), (2006, passages[4] * 4),
             (2007, text(900) + passages[3]), (2010, docs[11][1]), (2010, docs[11][1])]
    return docs


@pytest.mark.parametrize("length, lead, chunk", [(20, None, 20_000), (20, 4, 16), (20, 20, 3), (30, 1, 5)])
def test_remove_repeats(spark, length, lead, chunk):
    docs = made(length)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "*", "1 AS KEPT", "2 AS id0", "3 AS tie", "4 AS rest", "5 AS body", "6 AS spans", "7 AS `lead`", "8 AS th", "9 AS `a.b`")
    out = suffix_dedup.remove_repeats(df.repartition(5), length, lead, chunk=chunk)
    assert out.columns == ["doc_id", "id0", "tie", "rest", "body", "lead", "th", "a.b", "kept", "n_bytes", "n_removed", "n_spans", "spans"]
    want = brute(docs, length)
    got = sorted(((r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in out.collect()), key=repr)
    assert got == sorted(((d, *want[d, t]) for d, t in docs), key=repr)
    assert sum(r[3] for r in got) > 1000
    assert all(sum(s.hi - s.lo for s in r.spans) == r.n_removed and r.tie == 3 for r in out.collect())


def test_long_text_in_pieces(spark, monkeypatch):
    rnd = random.Random(4)
    long = "".join(rnd.choice("abcdefgh") for _ in range(30_000))
    docs = [(1, long), (2, long[10_000:20_150] + "!" + long[5_000:5_120]), (3, "zz" + long[4_000:4_050] + long[4_050:4_099])]
    poly = rolling.Prefixes()
    whole = suffix_dedup.anchors([t.encode() for _, t in docs], 100, 30, poly)
    monkeypatch.setattr(suffix_dedup, "PIECE", 512)
    parts = suffix_dedup.anchors([t.encode() for _, t in docs], 100, 30, poly)
    assert all((a == b).all() for a, b in zip(whole, parts))
    got = rows(suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).select("doc_id", "n_removed", "n_spans"))
    assert got == [(1, 0, 0), (2, 10_270, 2), (3, 0, 0)]


def test_one_key_for_many_rows(spark):
    """A passage that most texts share, between texts of their own: strings of one token fill
    several buckets and pieces."""
    rnd = random.Random(8)
    text = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage = text(140)
    docs = [(i, text(rnd.randrange(0, 60)) + passage[i % 7:] + text(rnd.randrange(0, 50))) for i in range(300)]
    out = suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(40), chunk=10)
    want = brute(docs, 100)
    assert {r.doc_id: bytes(r.kept) for r in out.collect()} == {d: want[d, t][0] for d, t in docs}


def test_multikey_order():
    rnd = random.Random(2)
    words = [bytes(rnd.choice(b"ab\x00\xff") for _ in range(rnd.randrange(0, 20))) for _ in range(400)]
    chars, lengths = suffix_dedup._characters(words, 20)
    order = suffix_dedup.multikey_order(chars)
    padded = [w.ljust(24, b"\0") for w in words]
    assert [padded[i] for i in order] == sorted(padded)
    common = suffix_dedup.common_prefixes(chars, order, lengths)
    for x, a, b in zip(common[1:], order, order[1:]):
        n = 0
        while n < min(len(words[a]), len(words[b])) and words[a][n] == words[b][n]:
            n += 1
        assert x == n


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = brute(docs, 100)
    got = rows(queries.op11_suffix_dedup(spark, SF_SMALL), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(((d, n, gone, runs, hashlib.sha256(kept).hexdigest()) for (d, _), (kept, n, gone, runs) in want.items()), key=repr)
    assert sum(r[2] for r in got) > 0
