"""Licence scan, quality rules, URL rules, WARC bundles: brute force and edge cases."""

import base64
import hashlib
import re

import pytest

from kickstar.llm import licenses, quality, urlrules, warc
from kickstar.llm.common import scratch
from tests.conftest import rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
EDGE = [(1, None), (2, ""), (3, " \n\t"), (None, "under the MIT License"), (4, "Ünder É\u00a0x"), (5, "a b " * 40_000), (5, "a b " * 40_000)]


def docs(spark, data, more=False):
    df = spark.createDataFrame(data, "doc_id long, text string")
    if more:
        df = df.selectExpr("doc_id", "text", "1 AS n_words", "2 AS KEPT", "'x' AS labels", "3 AS `a.b`")
    return df


def test_license_phrases_and_templates(spark):
    text = ("Copyright. Released under the MIT license. Apache License, Version 2.0! CC-BY-NC 4.0 and again under the mit license "
            "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License")
    got = licenses.scan(docs(spark, [(1, text)])).first()
    w = WORD.findall(text.lower())
    starts = [i for p in ("under the mit license", "apache license version 2", "cc by nc") for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    assert (got.n_words, got.n_base, got.first_word, got.last_word) == (len(w), len(starts), min(starts), max(starts))
    assert got.base_labels == "apache-2,cc-by-nc,mit" and got.labels == got.base_labels and 0 < got.score < 1


def test_license_edges(spark):
    got = {r.doc_id: r for r in licenses.scan(docs(spark, EDGE, more=True)).collect()}
    assert got[1].n_words == got[2].n_words == got[3].n_words == 0 and got[1].labels == "" and got[1].first_word is None
    assert got[None].labels == "mit" and got[5].n_words == 80_000
    assert licenses.scan(docs(spark, EDGE)).count() == len(EDGE) and licenses.scan(docs(spark, [])).count() == 0


@pytest.mark.parametrize("markup, yes, no", [
    ("a <<optional>>b<<end>> c", ["a c", "a b c"], ["a b b c", "a", "a x c"]),
    ("a <<var 1-2>> c", ["a x c", "a c c", "a x y c"], ["a c", "a x y z c"]),
    ("a <<optional>>b <<optional>>c<<end>> d<<end>> e", ["a e", "a b d e", "a b c d e"], ["a c e", "a b e", "a b c e"]),
    ("a <<var 0-0>> c", ["a c"], ["a x c"]),
])
def test_automaton(markup, yes, no):
    m = licenses.Automaton(markup)
    for t in yes:
        assert m.match(t.split(), 0) == len(t.split()), t
    for t in no:
        assert m.match(t.split(), 0) is None, t


@pytest.mark.parametrize("markup", ["<<optional>>a<<end>>", "a <<end>>", "a <<optional>>", "<<var 1-2>> a", "a <<var 3-2>>"])
def test_bad_markup(markup):
    with pytest.raises(ValueError):
        licenses.Automaton(markup)


def brute_quality(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    twice = {g for g in grams if grams.count(g) > 1} if len(grams) < 3000 else {g for g, c in __import__("collections").Counter(grams).items() if c > 1}
    hit = {i + k for i, g in enumerate(grams) if g in twice for k in range(3)}
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit), n < 50 or 100 * len(hit) > 50 * n


def test_quality_metrics(spark):
    data = EDGE + [(6, "a b c a b c d e a b"), (7, "x\ny\nx\n\n \nx\r"), (8, "#*$ %&|<> €𝒳 " * 30), (9, "one two three four\n" * 20), (10, "a b"),
                   (11, " ".join(f"w{i * i % 37}" for i in range(300)))]
    out = quality.judge(docs(spark, data, more=True))
    got = sorted((r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out.collect())
    assert got == sorted((d or 0, *brute_quality(t)) for d, t in data)
    assert [c for c in out.columns if c.lower() == "kept"] == ["kept"] and "a.b" in out.columns
    assert quality.judge(docs(spark, [])).count() == 0
    assert out.filter("kept and base_failed").count() == 0


def test_quality_keeps_prose_and_no_python(spark):
    prose = "It was a bright day in April, and the clocks of the town were striking as they had done for many years. " \
            "Nobody who lived there would have said that it was odd; the people in the square went on with what they were doing, " \
            "and the children looked up to count the strokes until the last of them had died away over the roofs."
    out = quality.judge(docs(spark, [(1, prose), (2, "lorem " * 100)]))
    assert rows(out, "doc_id", "kept") == [(1, True), (2, False)]
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


URLS = ["http://example.net/en/a", "https://A.B.Example.NET/en/", "http://example.net/en", "http://net/x", "http://xexample.net/en/x", None, "", "nothing",
        "http://example.com/de/q?x=/", "http://example.com?/de/", "http://fr.org/fr/#a", "ftp://org/fr/x://y", "http://org", "http://w.example.com/den/",
        "http:///en/", "http://é.net/", "http://example.net/en/deep/er", "http://example.net//en/"]


def brute_rule(url, rules):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[2:] if fit else (None, "allow")))


@pytest.mark.parametrize("more", [(), (("example.net", "/en/deep/", "block"), ("b.example.net", "/", "block"), ("example.net", "", "block"), ("com", "/de", "allow"))])
def test_url_rules(spark, more):
    rules = urlrules.RULES + more
    data = [(i, u) for i, u in enumerate(URLS)] + [(None, URLS[0]), (3, URLS[3]), (3, URLS[3])] + [(100 + i, "http://hot.example.net/en/hot") for i in range(300)]
    pages = spark.createDataFrame(data, "page_id long, url string").selectExpr("page_id", "url", "'x' AS host", "'y' AS verdict")
    got = rows(urlrules.judge(pages, urlrules.rules_frame(spark, rules)), "page_id", "host", "path", "rule", "verdict")
    assert got == sorted(((i, *brute_rule(u, rules)) for i, u in data), key=repr)


def test_url_rules_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert urlrules.judge(none).count() == 0
    some = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert urlrules.judge(some, spark.createDataFrame([], urlrules.RULE_SCHEMA), default="block").first().verdict == "block"


PAGES = [(3, "http://a/", "same"), (1, "http://b/%41 x\r\n", "same"), (2, None, None), (4, "u", ""), (None, "n", "same"), (5, "big", "é" * 700_000),
         (6, "z", "\r\n\r\nWARC/1.1\r\n"), (7, "t", "twice"), (7, "t", "twice")]


def brute_warc(pages):
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in pages:
        b = (h or "").encode()
        f = first.get(h or "")
        r = f if f is not None and f != i else None
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if r is None else "revisit", r))
    return sorted(out, key=repr)


def test_warc_round_trip(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 AS payload", "2 AS refers_to", "3 AS digest")
    path = scratch(spark, "test")
    warc.write_bundles(df.repartition(2), path, frame_bytes=300, bundle_bytes=500)
    back = warc.read_bundles(spark, path)
    assert rows(back, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == brute_warc(PAGES)
    texts = {(r.page_id, r.url): r.payload.decode() for r in back.collect() if r.record_type == "response"}
    assert texts[5, "big"] == "é" * 700_000 and texts[6, "z"] == PAGES[6][2] and texts[1, "http://b/%41 x\r\n"] == "same"
    one = warc.read_bundles(spark, path, wanted={6}).collect()
    assert [(r.page_id, r.payload.decode()) for r in one] == [(6, PAGES[6][2])]
    # any Zstandard reader sees the stream of records; the seek table leads to each frame
    import zstandard
    for f in spark.read.format("binaryFile").load(path).where("length > 0").collect():
        content = bytes(f.content)
        plain = b"".join(warc._frame(content, warc.seek_table(content), k) for k in range(len(warc.seek_table(content)) - 1))
        assert zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(content) == plain
        for page_id, frame, offset, length in warc.record_index(content):
            assert warc.parse(warc._frame(content, warc.seek_table(content), frame)[offset:offset + length])["page_id"] == page_id


def test_warc_small_payloads_and_empty(spark):
    path = scratch(spark, "test")
    warc.write_bundles(spark.createDataFrame(PAGES, "page_id long, url string, html string"), path, min_bytes=5)
    assert {(r.page_id, r.record_type) for r in warc.read_bundles(spark, path).collect() if r.payload_bytes < 5} == {(i, "response") for i, _, h in PAGES if len(h or "") < 5}
    path = scratch(spark, "test")
    warc.write_bundles(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_bundles(spark, path).count() == 0
