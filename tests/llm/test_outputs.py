"""Mixing, token files, token rollup, pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kickstar.llm import mixing, queries, token_blocks
from kickstar.llm.common import scratch
from kickstar.llm.token_rollup import Rollup
from tests.conftest import SF_SMALL, rows


def test_mixing_reaches_targets(spark):
    data = [(i, "x" * 50, "hot" if i % 3 else f"s{i % 9}") for i in range(6000)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    target = {"hot": 1.0, "s0": 2.0, "s3": 1.0}          # s6 has no weight
    got = Counter(r.source for r in mixing.mix(df, target, mixture=0.5).collect())
    assert set(got) == {"hot", "s0", "s3"}
    for s, w in target.items():
        mean = 6000 * 0.5 * w / 4
        assert abs(got[s] - mean) < 5 * math.sqrt(mean)


def brute_copies(doc_id, text, rate, seed=17):
    parts = math.ceil(rate / 16)
    part, n = rate / parts, 0
    who = f"{'' if doc_id is None else doc_id}:{hashlib.md5((text or '').encode()).hexdigest()}"
    for j in range(1, parts + 1):
        u = int(hashlib.md5(f"{seed}:{who}:{j}".encode()).hexdigest()[:13], 16) / 16 ** 13
        term = cdf = math.exp(-part)
        k = 0
        while cdf <= u:
            k += 1
            term *= part / k
            cdf += term
        n += k
    return n


def test_mixing_draws(spark):
    data = [(i, "t" * (i % 7), "a") for i in range(300)] + [(1000 + i, "t" * 5, None) for i in range(4)] + [(None, "n", "a"), (2000, None, "b"), (2001, "z", "c"), (2001, "z", "c")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string").selectExpr("*", "'x' AS copy", "1 AS SHUFFLE_KEY", "2 AS size", "3 AS rate")
    size = Counter()
    for _, t, s in data:
        size[s] += len(t or "")
    total, shares = sum(size.values()), sum(math.sqrt(v) for v in size.values())
    rate = {s: math.sqrt(v) / shares * total / v if v else 1.0 for s, v in size.items()}
    assert max(rate.values()) > 16           # a rate that is drawn in parts
    out = mixing.mix(df)
    got = Counter((r.doc_id, r.text, r.source) for r in out.collect())
    want = Counter()
    for d, t, s in data:
        want[d, t, s] += brute_copies(d, t, rate[s])
    assert got == +want
    assert len({r.shuffle_key for r in out.filter("doc_id <> 2001").collect()}) == out.filter("doc_id <> 2001").count()
    assert mixing.mix(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_blocks_round_trip(seed):
    rnd = np.random.default_rng(seed)
    for n in (0, 1, 127, 128, 129, 5000):
        ids = rnd.integers(0, rnd.choice([1, 2, 300, 50_000, 2**32 - 1]), n, dtype=np.uint64, endpoint=True).astype(np.uint32)
        ids[rnd.random(n) < 0.03] = 2**32 - 1
        area, starts = token_blocks.encode_blocks(ids, 128)
        assert (token_blocks.decode_blocks(area, starts, n, 128) == ids).all()
        if len(starts) > 2:
            assert (token_blocks.decode_blocks(area, starts, n, 128, 1, 2) == ids[128:256]).all()


def test_token_files(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.tokenizer_path())
    rnd = random.Random(4)
    alphabet = ["a", "B", " ", "  ", "\n", "\t", "'s", "é", "ñ", "漢", "😀", "1", "23", "#", "...", " ", "　", "\x00", "don't"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(0, 60))) for _ in range(200)]
    data = [(i * 3 % 211, x) for i, x in enumerate(texts)] + [(500, None), (501, ""), (502, "ab <|endoftext|> cd"), (503, "word " * 30_000), (None, "n")]
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 AS start", "2 AS th", "3 AS ids").repartition(5)
    path = scratch(spark, "test")
    token_blocks.write_tokens(df, path, queries.tokenizer_path(), file_tokens=500)
    back = token_blocks.with_starts(token_blocks.read_tokens(spark, path)).orderBy("start").collect()
    at = 0
    for (d, x), r in zip(sorted(data, key=lambda z: (z[0] is not None, z[0] or 0)), back, strict=True):
        ids = t.encode(x or "", add_special_tokens=False).ids + [0]
        assert (r.doc_id, r.start, r.n_tokens, list(r.ids)) == (d, at, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert spark.read.format("binaryFile").load(path).count() > 10


def test_encoder_mixed_white_space():
    encoder = token_blocks.Encoder(queries.tokenizer_path())
    rnd = random.Random(8)
    space = [" ", " ", " ", "\u00a0", "\u00a0", "\t", "\n", "\r\n", "\u2003", "\u3000", "\v", "\f"]
    texts = ["a \u00a0 \u00a0 b", "a\n ", " \u00a0 ", "a\t \tb", "\u00a0 b", "a \u00a0"]
    texts += ["".join(rnd.choice(space if rnd.random() < 0.7 else ["a", "Word", "é", "'s", "12", "#!", "漢"]) for _ in range(rnd.randrange(1, 25))) for _ in range(20_000)]
    for text, got in zip(texts, encoder(texts), strict=True):
        assert got.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_token_files_repeated_ids_and_empty(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "bb cc")], "doc_id long, text string")
    path = scratch(spark, "test")
    token_blocks.write_tokens(df, path, queries.tokenizer_path())
    assert token_blocks.read_tokens(spark, path).count() == 3
    path = scratch(spark, "test")
    token_blocks.write_tokens(df.limit(0), path, queries.tokenizer_path())
    assert token_blocks.with_starts(token_blocks.read_tokens(spark, path)).count() == 0


CHANGE = "doc_id long, source string, lang string, tokenizer string, n_tokens long, deleted boolean"


def test_rollup(spark):
    store = Rollup(spark, scratch(spark, "test"))
    frame = lambda x: spark.createDataFrame(x, CHANGE).selectExpr("*", "1 AS sign", "'x' AS r")
    assert store.totals().count() == 0 and store.current().count() == 0
    assert store.apply("b1", frame([(1, "s", "en", "v1", 10, False), (2, "s", None, "v1", 5, False), (3, None, "en", "v1", None, None), (None, "s", "en", "v1", 9, False),
                                    (4, "s", "en", "v1", 7, False), (4, "s", "en", "v1", 7, False)]))
    assert store.apply("b2", frame([(1, "s", "en", "v2", 12, False), (2, None, None, None, 0, True), (8, None, None, None, 0, True)]))
    want = [("s", "en", "v1", 1, 7), ("s", "en", "v2", 1, 12), (None, "en", "v1", 1, 0)]
    assert rows(store.totals()) == sorted(want, key=repr)
    assert not store.apply("b1", frame([(1, "s", "en", "v1", 99, False)]))
    assert store.apply("b3", frame([]))
    assert rows(Rollup(spark, store.path).totals()) == sorted(want, key=repr)
    with pytest.raises(ValueError):
        store.apply("a=b", frame([]))


def test_rollup_survives_a_lost_attempt(spark, monkeypatch):
    store = Rollup(spark, scratch(spark, "test"))
    one = spark.createDataFrame([(1, "s", "en", "v1", 10, False)], CHANGE)

    def lost(*_):
        raise RuntimeError("lost before the commit")

    with monkeypatch.context() as m:
        m.setattr(Rollup, "_commit", lost)
        with pytest.raises(RuntimeError):
            store.apply("b1", one)
    assert store.totals().count() == 0
    assert store.apply("b1", one)
    assert rows(store.totals()) == [("s", "en", "v1", 1, 10)]


def test_rollup_of_overlapping_batches(spark, monkeypatch):
    """A batch that was prepared before another one was committed is prepared again: a document
    that both change counts once."""
    store = Rollup(spark, scratch(spark, "test"))
    frame = lambda x: spark.createDataFrame(x, CHANGE)
    assert store.apply("a", frame([(1, "s", "en", "v", 10, False)]))
    real, held = Rollup._commit, []

    def late(self, number, entry):
        if entry["batch"] == "b" and not held:
            held.append(entry["attempt"])
            assert Rollup(spark, store.path).apply("c", frame([(1, "s", "en", "v", 30, False), (2, "s", "en", "v", 1, False)]))
        return real(self, number, entry)

    monkeypatch.setattr(Rollup, "_commit", late)
    assert store.apply("b", frame([(1, "s", "en", "v", 20, False)]))
    assert rows(store.totals()) == [("s", "en", "v", 2, 21)] and rows(store.current(), "doc_id", "n_tokens") == [(1, 20), (2, 1)]
    assert list(store.committed()) == ["a", "c", "b"] and held[0] not in store.committed().values()


def test_rollup_against_replay(spark):
    """Many batches over few buckets, compacted again and again, against a plain replay."""
    rnd, store, now = random.Random(3), Rollup(spark, scratch(spark, "test"), buckets=3, compact=2), {}
    for k in range(9):
        batch = {}
        for _ in range(rnd.randrange(0, 8)):
            d = rnd.randrange(12)
            batch[d] = (d, rnd.choice("st"), "en", f"v{k}", rnd.randrange(50), rnd.random() < 0.3)
        assert store.apply(f"b{k}", spark.createDataFrame(list(batch.values()), CHANGE))
        for d, row in batch.items():
            now[d] = None if row[5] else row[1:5]
        want = {}
        for v in filter(None, now.values()):
            n, t = want.get(v[:3], (0, 0))
            want[v[:3]] = n + 1, t + v[3]
        assert rows(store.totals(), "source", "lang", "tokenizer", "n_docs", "n_tokens") == sorted([(*k, *v) for k, v in want.items()], key=repr)
        assert rows(store.current(), "doc_id", "n_tokens") == sorted(((d, v[3]) for d, v in now.items() if v), key=repr)
    assert any(e["whole"] for e in store.log.entries())
    assert all(len(c) <= 3 for c in Rollup._chains(store.log.entries()).values())


def test_rollup_of_token_ids(spark):
    """Counts of a tokenizer file, by source and language, against the library."""
    from tokenizers import Tokenizer

    from kickstar.llm.token_rollup import token_counts
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").unionByName(
        spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "", None, None, 0)], "doc_id long, text string, lang string, source string, n_chars long"))
    encode = Tokenizer.from_file(queries.tokenizer_path()).encode
    want = {}
    for r in docs.collect():
        n, t = want.get((r.source, r.lang), (0, 0))
        want[r.source, r.lang] = n + 1, t + len(encode(r.text or "", add_special_tokens=False).ids)
    store = Rollup(spark, scratch(spark, "test"))
    assert store.apply("load", token_counts(docs.withColumn("n_tokens", F.lit(7)), queries.tokenizer_path(), "byte-bpe-50k"))
    assert rows(store.totals()) == sorted([(s, x, "byte-bpe-50k", *v) for (s, x), v in want.items()], key=repr)


def test_pipeline_stages(spark):
    """Every stage against a brute-force version, over its own input."""
    import corpus_pipeline as C
    from tests.llm.test_joins import brute_contaminated, brute_near
    from tests.llm.test_texts import brute_quality
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    columns = docs.columns
    data = [tuple(r) for r in docs.collect()]
    text = columns.index("text")
    for name, stage in C.STAGES:
        out = stage(spark, spark.createDataFrame(data, docs.schema), SF_SMALL)
        got = [tuple(r) for r in out.collect()]
        pairs = [(r[0], r[text]) for r in data]
        if name == "quality_rules":
            assert all(not brute_quality(r[text])[-1] for r in got) and 0 < len(got) < len(data)
            assert set(got) <= set(data)
        elif name == "near_duplicates":
            assert sorted(r[0] for r in got) == sorted({c for _, c, _ in brute_near(pairs)})
        elif name == "decontamination":
            assert sorted(r[0] for r in got) == sorted(x[0] for x in brute_contaminated(pairs, bench) if not x[-1])
        elif name == "source_mixing":
            assert set(got) <= set(data) and 0.7 * len(data) < len(got) < 1.4 * len(data)
        else:
            assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
            assert sorted(r[0] for r in got) == sorted(r[0] for r in data)
            break
        assert out.columns == columns
        data = got


def brute_kept(text):
    """All quality rules, from their published bounds."""
    from kickstar.llm.quality import STOP_WORDS
    from tests.llm.test_texts import brute_quality
    n, chars, symbols, twice, _, failed = brute_quality(text)
    lines = sum(any(c not in " \t\n\v\f\r" for c in x) for x in (text or "").split("\n"))
    stops = sum(w.lower() in STOP_WORDS for w in re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    return not failed and 2 * n <= chars <= 15 * n and 10 * symbols <= n and 10 * twice <= 3 * lines and 50 * stops >= n


def brute_mixture(data, text, source):
    size = Counter()
    for r in data:
        size[r[source]] += len(r[text] or "")
    total, shares = sum(size.values()), sum(math.sqrt(v) for v in size.values())
    rate = {s: math.sqrt(v) / shares * total / v if v else 1.0 for s, v in size.items()}
    out = Counter()
    for r in data:
        out[r] += brute_copies(r[0], r[text], rate[r[source]])
    return +out


def brute_tokens(data, text):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.tokenizer_path())
    at, out = 0, []
    for r in sorted(data, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(t.encode(r[text] or "", add_special_tokens=False).ids + [0], "<u4")
        out.append((r[0], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_pipeline_rows(spark):
    """The rows of every stage, no fewer and no more, from the stage's own input."""
    import corpus_pipeline as C
    from tests.llm.test_joins import brute_contaminated, brute_near
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    text, source = docs.columns.index("text"), docs.columns.index("source")
    data = [tuple(r) for r in docs.collect()]
    for name, stage in C.STAGES:
        got = [tuple(r) for r in stage(spark, spark.createDataFrame(data, docs.schema), SF_SMALL).collect()]
        pairs = [(r[0], r[text]) for r in data]
        if name == "quality_rules":
            want = Counter(r for r in data if brute_kept(r[text]))
        elif name == "near_duplicates":
            keep = {c for _, c, _ in brute_near(pairs)}
            want = Counter(r for r in data if r[0] in keep)
        elif name == "decontamination":
            clean = {x[0] for x in brute_contaminated(pairs, bench) if not x[-1]}
            want = Counter(r for r in data if r[0] in clean)
        elif name == "source_mixing":
            want = brute_mixture(data, text, source)
        else:
            want = Counter(brute_tokens(data, text))
        assert Counter(got) == want and got, name
        data = got


def test_operator_queries_match_sql(spark):
    import duckdb

    from kickstar.llm import sql
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name, text in sql.SQL.items():
        got = queries.queries()[name](spark, SF_SMALL)
        cols = sorted(got.columns)
        rel = con.sql(text)
        at = [rel.columns.index(c) for c in cols]
        assert sorted(rel.columns) == cols, name
        want = sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)
        assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=repr) == want, name
