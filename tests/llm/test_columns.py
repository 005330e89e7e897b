"""Extra columns with the names of helper columns, in every operator that keeps columns."""

from pyspark.sql import functions as F

from kickstar.llm import decontaminate, line_dedup, mixing, ngram_join, quality, urlrules
from tests.conftest import rows

DOCS = [(i, f"some words {'that repeat ' * (i % 4)}here\nand line {i % 3}", "s" if i % 3 else None) for i in range(12)] + [(20, None, "t"), (None, "x", "t")]
HELPERS = ["__w", "__m", "__h", "__l", "__source", "__who", "__parts", "__cdf", "__n", "__id", "__pid", "__ph", "w", "wid", "hits", "places", "text_",
           "__gid", "__gh", "__gone", "__lines", "__th", "__gth", "doc", "seq", "rank", "root", "sig", "a.b"]


def _docs(spark, extra):
    return spark.createDataFrame(DOCS, "doc_id long, text string, source string").withColumns({c: F.lit(i) for i, c in enumerate(extra)})


def test_helper_names(spark):
    extra = HELPERS
    plain, more = _docs(spark, []), _docs(spark, extra)
    bench = spark.createDataFrame([(1, "some words that repeat")], "item_id long, text string")
    ways = {
        "quality": lambda d: quality.judge(d), "mix": lambda d: mixing.mix(d), "decontaminate": lambda d: decontaminate.contaminated(d, bench),
        "lines": lambda d: line_dedup.dedup_lines(d, 3), "keep_one": lambda d: ngram_join.keep_one(d)}
    for name, way in ways.items():
        a, b = way(plain), way(more)
        assert [c for c in b.columns if c not in extra] == a.columns, name
        assert rows(b.select(*[f"`{c}`" for c in a.columns])) == rows(a), name
        assert {tuple(r) for r in b.select(*[f"`{c}`" for c in extra]).collect()} <= {tuple(range(len(extra)))}, name


def test_mixing_of_empty_and_long(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(none).count() == 0
    docs = spark.createDataFrame([(1, "long " * 200_000, "a"), (2, "short", "a"), (3, "", "b"), (4, None, None)], none.schema)
    got = mixing.mix(docs, temperature=1.0).groupBy("doc_id").count()
    assert {r.doc_id for r in got.collect()} <= {1, 2, 3, 4}
    assert {r.text for r in mixing.mix(docs, mixture=3.0).filter("doc_id = 1").collect()} <= {"long " * 200_000}


def test_long_hosts(spark):
    labels = ".".join(["x"] * 100_000)
    urls = [(1, f"http://{labels}.example.net/en/a"), (2, f"http://{labels}.net/z"), (3, f"http://{labels}/en/"), (4, "http://example.net/en/"), (5, None)]
    got = urlrules.judge(spark.createDataFrame(urls, "page_id long, url string"))
    assert rows(got, "page_id", "rule", "verdict") == [(1, "example.net/en/", "allow"), (2, "net/", "block"), (3, None, "allow"),
                                                       (4, "example.net/en/", "allow"), (5, None, "allow")]
    assert urlrules.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_pieces_are_held_from_their_second_time_on():
    from kickstar.llm.token_blocks import _Kept
    asked = []
    kept = _Kept(lambda k: asked.append(k) or k.encode(), 10)
    for i in range(1000):                               # keys that come once take no place
        assert kept[f"once {i}"] == f"once {i}".encode()
    assert len(kept) + len(kept.old) <= 2
    for _ in range(3):
        assert kept["again"] == b"again"
    assert asked.count("again") <= 2
    for i in range(100):
        assert [kept[f"k{i}"], kept[f"k{i}"]] == [f"k{i}".encode()] * 2
    assert len(kept) + len(kept.old) <= 20
