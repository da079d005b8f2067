"""Language identification against plain loops over all pages."""

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from newsquake.llm import languages as L
from newsquake.llm.common import Shelf, table

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def shelf(spark, tmp_path):
    return Shelf(spark, str(tmp_path.name))


def plain_model(docs):
    """docs: (id, text, lang); every one is in the sample."""
    codes = sorted({lang for _, text, lang in docs if lang is not None and text is not None})
    counts = {c: Counter() for c in codes}
    for _, text, lang in docs:
        if lang is not None and text is not None:
            for word in re.sub(r"[\W\d_]", " ", text.lower()).split():
                counts[lang].update(f" {word} "[i : i + 3] for i in range(len(word)))
    known = set().union(*counts.values()) if codes else set()
    totals = [sum(counts[c][t] + 0.5 for t in known) + 0.5 for c in codes]
    return codes, {t: [math.log((counts[c][t] + 0.5) / n) for c, n in zip(codes, totals)] for t in known}


def plain_languages(pages, docs):
    """pages: (id, url, html) -> {id: (lang, probability)}."""
    codes, model = plain_model(docs)
    n = len(codes)
    told = []
    for key, url, html in pages:
        html, url = html or "", url or ""
        bare = re.sub(r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", " ", html)
        bare = re.sub(r"&#?\w+;", " ", re.sub(r"(?s)<[^>]*>", " ", bare))
        total = [0.0] * n
        for word in re.sub(r"[\W\d_]", " ", bare.lower()).split():
            for i in range(len(word)):
                for k, v in enumerate(model.get(f" {word} "[i : i + 3], [])):
                    total[k] += v * L.TEMPER
        top = max(total)
        norm = top + math.log(sum(math.exp(v - top) for v in total))
        declared = re.search(r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([a-z]+)""", html)
        host = re.split(r"[/?#]", url.split("://", 1)[1])[0].lower() if "://" in url else ""
        labels = host.split(".")
        site = ".".join(labels[-2:]) if len(labels) > 1 and all(labels[-2:]) else ""
        told.append((key, [v - norm for v in total], declared.group(1).lower() if declared else "", host, site, labels[-1]))
    level = [defaultdict(lambda: [0.0] * n) for _ in range(5)]  # all, suffix, site, host, declared
    for _, text, declared, host, site, suffix in told:
        for sums, k in zip(level, ["", suffix, (suffix, site), host, declared]):
            sums[k] = [a + math.exp(v) for a, v in zip(sums[k], text)]
    world = level[0][""]
    smooth = lambda own, above: [(a + L.STRENGTH * p) / (sum(own) + L.STRENGTH) for a, p in zip(own, above)]
    out = {}
    for key, text, declared, host, site, suffix in told:
        prior = [(w + 1) / (sum(world) + n) for w in world]
        for sums in (level[1][suffix], level[2][(suffix, site)], level[3][host]):
            prior = smooth(sums, prior)
        fused = [t + math.log(p) for t, p in zip(text, prior)]
        if declared:
            said = level[4][declared]
            own = [L.FAITH if c == declared else L.FAITH / (n + 1) for c in codes]
            fused = [f + math.log((s + o) / (w + 2 * L.FAITH)) for f, s, o, w in zip(fused, said, own, world)]
        top = max(fused)
        out[key] = (codes[fused.index(top)], 1 / sum(math.exp(f - top) for f in fused))
    return out


def compare(pages, docs, shelf, rows, texts):
    got = {r.page_id: r.language for r in L.identify(pages, docs, shelf).collect()}
    want = plain_languages(rows, texts)
    assert got.keys() == want.keys()
    for key, (lang, probability) in want.items():
        assert got[key].probability == pytest.approx(probability, rel=1e-6), key
        assert got[key].lang == lang, key


def test_whole_tables_against_loops(spark, shelf):
    docs, pages = table(spark, DATA, "documents").select("doc_id", "text", "lang"), table(spark, DATA, "pages").select("page_id", "url", "html")
    assert docs.groupBy("lang").count().agg(F.max("count")).first()[0] <= L.SAMPLE
    compare(pages, docs, shelf, [tuple(r) for r in pages.collect()], [tuple(r) for r in docs.collect()])


def test_long_null_and_repeated_pages(spark, shelf):
    texts = [(1, "the cat and the dog went there", "en"), (2, "der hund und die katze gingen dort", "de"), (3, None, "fr"), (4, "no label", None)]
    rows = [(i, f"http://h{i % 3}.x.de/{i}", "<html lang='de'><p>der hund</p>") for i in range(30)]
    rows += [(40, None, None), (41, "", ""), (42, "http://b.org", "<p>the dog &amp; the cat</p><script>der die und</script>"), (43, "http://c.org/a", "<p>" + "der hund the cat " * 60_000 + "</p>")]
    rows += [(44, "http://b.org", "<html lang=en><p>der</p>"), (45, "http://c.org", "<html lang=xx>")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, lang string")
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    compare(pages, docs, shelf, rows, texts)
    twice = L.identify(pages.union(pages), docs, shelf).groupBy("page_id").agg(F.count("*").alias("n"), F.countDistinct("language.lang").alias("d"))
    assert {(r.n, r.d) for r in twice.collect()} == {(2, 1)}


def test_ties_take_the_first_code(spark, shelf):
    texts = [(1, "aaa bbb", "zz"), (2, "aaa bbb", "aa")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, lang string")
    pages = spark.createDataFrame([(1, "http://x.y/", "<p>aaa</p>"), (2, None, None)], "page_id int, url string, html string")
    assert {(r.language.lang, r.language.text_lang, r.language.probability) for r in L.identify(pages, docs, shelf).collect()} == {("aa", "aa", 0.5)}


def test_a_language_with_little_text_keeps_its_triples(spark, shelf, monkeypatch):
    monkeypatch.setattr(L, "TRIPLES", 3)
    rows = [(i, "abcdefgh " * 50, "aa") for i in range(5)] + [(9, "xyz", "zz")]
    _, model = L.fit_text(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), shelf)
    assert {" xy", "xyz", "yz "} <= set(model)


def test_sample_by_ids(spark, shelf):
    rows = [(i, f"word{'abcdefghij'[i % 10] * 3}", "aa") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    picked = docs.orderBy(F.xxhash64("doc_id"), "doc_id").limit(7)
    codes, model = L.fit_text(docs, shelf, sample=7)
    want, same = plain_model([tuple(r) for r in picked.collect()])
    assert codes == want and {t: list(v) for t, v in model.items()} == {t: pytest.approx(v) for t, v in same.items()}
    # Null ids and copies of one id share one place.
    odd = spark.createDataFrame([(None, "abc", "aa"), (None, "abd", "aa"), (1, "xyz", "bb"), (1, "xyz", "bb")], docs.schema)
    assert set(L.fit_text(odd, shelf)[1]) == {" ab", "abd", "bd ", " xy", "xyz", "yz "}


def test_empty_tables(spark, shelf):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    pages = spark.createDataFrame([], "page_id int, url string, html string")
    assert L.fit_text(docs, shelf) == (["und"], {})
    assert L.identify(pages, docs, shelf).count() == 0
    some = spark.createDataFrame([(1, "the cat", "en")], docs.schema)
    assert L.identify(pages, some, shelf).count() == 0
