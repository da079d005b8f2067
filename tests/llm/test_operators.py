"""Each operator against a brute-force version, on small tables with nulls, empty texts, ties, repeats and odd columns."""

import hashlib
import itertools
import random

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from newsquake.llm import automaton, chat, licenses, lines, mixing, overlap, simhash, suffixes, toxicity, urls
from newsquake.llm.common import Shelf
from newsquake.llm.languages import identify
from newsquake.llm.oracle import BASE, ORACLE
from newsquake.llm.queries import QUERIES
from tools.check import TABLES, _rows

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, key string, id string, row string"
DATA = "/root/testdata/sf0.001"


def prose(seed, n, words=400):
    r = random.Random(seed)
    return " ".join(f"w{int(r.paretovariate(0.9)) % words}" for _ in range(n))


def edited(text, seed, every):
    r = random.Random(seed)
    return " ".join(w if r.random() > 1 / every else f"x{r.randrange(999)}" for w in text.split())


PASSAGE = prose("passage", 80)
TEXTS = [
    (1, prose(1, 200)), (2, prose(1, 200)), (3, edited(prose(1, 200), 3, 90)), (4, prose(4, 300) + " " + PASSAGE), (5, PASSAGE + " é " + prose(5, 120)),
    (6, None), (7, ""), (8, " \n\t "), (9, "é" * 350), (10, "é" * 350), (11, "short one"), (12, "ab" * 400), (12, prose(12, 60)), (13, prose(13, 30_000)),
    (14, prose(14, 90)), (14, prose(14, 90)), (None, prose(15, 70)), (16, "The MIT License and\nthe mit license. CC BY-NC 4.0, licensed under CC BY NC"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", s, 0, 7, "k", "x", "r") for (i, t), s in zip(TEXTS, itertools.cycle(["b", "a", "c", None, "a"]))]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def shelf(spark, tmp_path):
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path))
    return Shelf(spark, "test")


def removed(texts, threshold):
    starts = {}
    for d, t in enumerate(texts):
        for i in range(len(t) - threshold + 1):
            starts.setdefault(t[i : i + threshold], []).append((d, i))
    gone = [bytearray(len(t)) for t in texts]
    for where in starts.values():
        for d, i in where if len(where) > 1 else ():
            gone[d][i : i + threshold] = b"\1" * threshold
    return gone


@pytest.mark.parametrize("threshold", [24, 200])
def test_suffixes_remove_what_brute_force_removes(docs, shelf, threshold):
    rows = [(i, (t or "").encode()[:5000]) for i, t in TEXTS]
    cut = suffixes.remove_repeats(docs.withColumn("text", F.substring("text", 1, 4000)), shelf, threshold)
    rows = [(i, (t or "")[:4000].encode()) for i, t in TEXTS]
    wanted = []
    for (i, t), gone in zip(rows, removed([t for _, t in rows], threshold)):
        spans = sum(1 for a, b in zip(b"\0" + bytes(gone), bytes(gone)) if b and not a)
        wanted.append((str(i), len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    got = [(str(r.doc_id), r.cut.n_bytes, r.cut.n_removed, r.cut.n_spans, bytes(r.cut.kept)) for r in cut.collect()]
    assert sorted(got) == sorted(wanted)


def test_suffixes_keep_columns_and_whole_characters(docs, nothing, shelf):
    out = suffixes.without_repeats(docs, shelf)
    assert out.columns == docs.columns and out.count() == len(TEXTS)
    assert {r.doc_id: r.text for r in out.collect()}[9] == ""
    assert suffixes.without_repeats(nothing, shelf).count() == 0


def test_simhash_components_match_all_pairs(docs, nothing, shelf):
    found = simhash.simhash_components(docs, shelf).collect()
    prints = {}
    for i, t in TEXTS:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
        grams = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        prints.setdefault(i, set()).add(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    assert {(r.id, r.fp % 2**64) for r in found} == {(i, p) for i, s in prints.items() for p in s}
    every = sorted({(i is None, i, p) for i, s in prints.items() for p in s}, key=str)
    root = {x: x for x in every}
    for a, b in itertools.product(every, every):
        if (a[2] ^ b[2]).bit_count() <= 4:
            old, new = root[b], root[a]
            root = {k: new if v == old else v for k, v in root.items()}
    for r in found:
        mine = root[(r.id is None, r.id, r.fp % 2**64)]
        assert r.component == min((x[1] for x in every if root[x] == mine and x[1] is not None), default=None)
    assert simhash.simhash_components(nothing, shelf).count() == 0


@pytest.mark.parametrize(("parts", "distance"), [(1, 0), (2, 3), (3, 4), (5, 4)])
def test_segments_miss_no_pair(parts, distance):
    pieces = simhash.exact_segments("c", parts, distance)
    assert sum(s.width for s in pieces) == 64
    r = random.Random(1)
    for _ in range(500):
        bits = r.sample(range(64), distance)
        assert any(sum(s.at <= b < s.at + s.width for b in bits) <= s.radius for s in pieces)


def test_majority_counts_over_half():
    h = np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64)
    for n in (0, 1, 2, 254, 255, 256, 1000):
        want = sum(1 << b for b in range(64) if 2 * int(((h[:n] >> np.uint64(b)) & np.uint64(1)).sum()) > n)
        assert simhash.majority(h[:n]) % 2**64 == want


def test_one_of_each_keeps_one_copy(docs, nothing, shelf):
    out = overlap.one_of_each(docs, shelf)
    ids = sorted(str(r.doc_id) for r in out.collect())
    # 2 and 3 copy 1, 10 copies 9, one row of 14 goes; 6, 7 and 8 have no words.
    assert ids == sorted(map(str, [1, 4, 5, 6, 9, 11, 12, 12, 13, 14, None, 16])) and out.columns == docs.columns
    assert overlap.one_of_each(nothing, shelf).count() == 0


def test_automaton_finds_windows(spark, docs, nothing, shelf):
    words = PASSAGE.split()
    items = [(1, " ".join(words[10:40])), (2, " ".join(words[35:42])), (3, None), (4, ""), (1, prose(14, 90).upper()), (None, "short one"), (5, "never there at all")]
    table = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, name string")
    for block in (10**6, 200):  # one automaton, and several
        got = automaton.find_items(docs, table, shelf, block_chars=block).collect()
        for r in got:
            text = automaton.words_of((r.text or "").encode())
            hit, names = set(), set()
            for name, body in items:
                item = automaton.words_of((body or "").encode())
                n = min(10, len(item))
                windows = {tuple(item[k : k + n]) for k in range(len(item) - n + 1)} if n else set()
                for k in range(len(text) - n + 1 if n else 0):
                    if tuple(text[k : k + n]) in windows:
                        hit |= set(range(k, k + n))
                        names.add("" if name is None else str(name))
            assert (r.seen.n_words, r.seen.n_hit, r.seen["items"]) == (len(text), len(hit), sorted(names))
    out = {str(r.doc_id): r.text for r in automaton.without_items(docs, table, shelf).collect()}
    assert "14" not in out and "11" not in out and out["6"] is None and out["1"] == prose(1, 200)
    assert " ".join(words[10:42]) not in out["4"] and words[5] in out["4"]
    assert automaton.find_items(nothing, table, shelf).count() == 0


def test_mixing_takes_exact_budgets(docs, nothing, shelf):
    got = mixing.mix(docs, shelf).collect()
    size = {}
    for r in got:
        size[r.source] = size.get(r.source, 0) + r["size"]
    order = sorted(s for s in size if s is not None) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    full, total = {}, 1.5 * sum(size.values())
    while True:
        rest = {s: (total - sum(full.values())) * weight[s] / sum(weight[x] for x in order if x not in full) for s in order if s not in full}
        over = [s for s, t in rest.items() if t > 2 * size[s]]
        if not over:
            break
        full |= {s: 2.0 * size[s] for s in over}
    for r in got:
        assert r.target == pytest.approx((full | rest)[r.source]) and r.source_size == size[r.source] and 0 <= r.taken <= 2 * r["size"]
    for s in order:
        assert sum(r.taken for r in got if r.source == s) == int((full | rest)[s])
    mixed = mixing.mixed_documents(docs, shelf)
    assert mixed.columns == [*docs.columns, "mix_size", "mix_target", "mix_taken"]
    assert mixed.count() == sum(r.taken > 0 for r in got) and mixing.mix(nothing, shelf).count() == 0


def test_chat_round_trip_of_hostile_texts(spark):
    r = random.Random(1)
    bits = ["<|im_end|>", "<|im_start|>", "\n", "<", "|", "\\", "<\\|", "a", "%0A", "%3C", "%", "assistant", "<|im_end|>\n", "$1"]
    mix = lambda k: "".join(r.choice(bits) for _ in range(r.randint(0, k)))
    rows = [(c, t, r.choice(["user", "assistant", None, mix(3)]), mix(8) if r.random() < 0.9 else None) for c in range(150) for t in range(r.randint(1, 4))]
    rows += [(None, 0, "user", "x"), (None, None, "assistant", "y"), (0, 0, rows[0][2], rows[0][3])]
    out = {o.conv: o for o in chat.format_chats(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    for conv in {row[0] for row in rows}:
        turns = sorted((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv)
        o = out[conv]
        assert [(t.role, t.text) for t in o.turns] == [t[2:] for t in turns]
        assert o.loss_text == "".join(t[3] for t in turns if t[2] == "assistant") and o.n_turns == len(turns)
    assert {o.level for o in out.values()} == {0, 1, 2}
    assert chat.format_chats(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


def test_cascade_is_exact_over_its_universe(spark, shelf):
    universe = spark.range(6000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = spark.range(0, 6000, 7).select(F.concat(F.lit("k"), "id").alias("key"))
    cascade = urls.build_cascade(urls.marked_keys(listed.union(spark.createDataFrame([(None,)], "key string")), universe, shelf), shelf, 1000)
    got = universe.where(cascade.listed(F.col("key"))).count()
    assert got == listed.count() == universe.where(cascade.listed(F.col("key"))).join(listed, "key").count() and len(cascade.levels) > 1
    assert universe.where(urls.build_cascade(urls.marked_keys(listed.limit(0), universe, shelf), shelf, 1000).listed(F.col("key"))).count() == 0
    assert urls.build_cascade(urls.marked_keys(listed, universe, shelf), shelf, 100) is None


def test_urls_of_any_form(spark, shelf):
    rows = [(1, None, 0), (2, "no scheme", 0), (3, "x://A.Com/en/1?q", 0), (4, "x://a.com", 0), (5, "x://bad.io/p#f", 0), (6, "x://bad.io/q", 0), (7, "", 0), (7, "", 0)]
    pages = spark.createDataFrame(rows, "page_id int, url string, host int")
    listed = spark.createDataFrame([("bad.io/p",)], "key string")
    for largest in (urls.LARGEST, 1):
        got = {r.page_id: tuple(r.judged) for r in urls.judge(pages, listed, [("com", "/en/", "block")], shelf, largest=largest).collect()}
        assert got == {1: ("", "", None, "allow"), 2: ("", "", None, "allow"), 3: ("a.com", "/en/1", "com/en/", "block"), 4: ("a.com", "", None, "allow"), 5: ("bad.io", "/p", None, "block"), 6: ("bad.io", "/q", None, "allow"), 7: ("", "", None, "allow")}
    assert urls.judge(pages.limit(0), listed, [], shelf).count() == 0


def test_urls_in_blocks(spark, shelf):
    pages = spark.range(900).select((F.col("id") % 800).alias("page_id"), F.concat(F.lit("http://h.org/"), F.col("id") % 800).alias("url"), F.lit(1).alias("judged"), F.lit("x").alias("block"))
    listed = spark.range(0, 800, 9).select(F.concat(F.lit("h.org/"), "id").alias("key"))
    got = urls.judge(pages, listed, [], shelf, largest=30)
    assert got.columns == ["page_id", "url", "judged", "block", "judged_"]
    told = got.select("page_id", "block", "judged_.verdict").collect()
    assert sorted((r.page_id, r.verdict) for r in told) == sorted((i % 800, "block" if i % 800 % 9 == 0 else "allow") for i in range(900))
    assert {r.block for r in told} == {"x"}


def test_licenses(docs, nothing, shelf):
    got = {str(r.id): r for r in licenses.scan_licenses(docs, shelf).collect()}
    r = got["16"]
    assert (r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == (4, 1, 14, "cc-by,mit", "cc-by,cc-by-nc,mit", 1.0)
    assert (got["6"].n_words, got["6"].labels, got["6"].score, got["6"].first_word) == (0, "", 0.0, None)
    assert licenses.scan_licenses(nothing, shelf).count() == 0


def test_merged_diagonals_survive_a_lost_word(spark, shelf):
    words = licenses.NOTICES[11][0].split()
    text = " ".join(words[:9] + ["big"] + words[9:])
    docs = spark.createDataFrame([(1, "before " + text), (2, " ".join(words[:6]))], "doc_id bigint, text string")
    got = {r.id: r for r in licenses.scan_licenses(docs, shelf).collect()}
    assert got[1].labels == "mit" and got[1].base_labels == "" and 0.85 <= got[1].score < 1 and got[2].labels == ""


def chain_share(words, notice):
    """The longest chain of pairs of words that goes forward in both, over the notice's pairs, by plain loops."""
    mine, theirs = list(zip(words, words[1:])), list(zip(notice, notice[1:]))
    best = [[0] * (len(theirs) + 1) for _ in range(len(mine) + 1)]
    for i, a in enumerate(mine):
        for j, b in enumerate(theirs):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + (a == b))
    return best[-1][-1] / len(theirs)


def test_notices_with_one_word_changed_anywhere(spark, shelf):
    texts = []
    for notice, _ in licenses.NOTICES:
        words = notice.split()
        for at in range(len(words)):
            for changed in (words[:at] + ["zebra"] + words[at:], words[:at] + words[at + 1 :], words[:at] + ["zebra"] + words[at + 1 :]):
                texts.append(["some", "text"] + changed + ["and", "more"])
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id bigint, text string")
    got = {r.id: r for r in licenses.scan_licenses(docs, shelf).collect()}
    for i, words in enumerate(texts):
        shares = [(chain_share(words, notice.split()), label) for notice, label in licenses.NOTICES]
        base = set(filter(None, got[i].base_labels.split(",")))
        want = {label for share, label in shares if share >= licenses.SHARE}
        assert set(filter(None, got[i].labels.split(","))) == base | want, " ".join(words)
        assert got[i].score == max([1.0] * bool(base) + [share for share, _ in shares if share >= licenses.SHARE], default=0.0), " ".join(words)
    many = licenses.NOTICES[10][0]
    both = spark.createDataFrame([(1, " ".join([many] * 40)), (2, many.replace("obtain", "freely obtain"))], "doc_id bigint, text string")
    spans = {r.id: r.spans for r in licenses.scan_licenses(both, shelf).collect()}
    size = len(many.split())
    assert [(s.start, s.end) for s in spans[1]] == [(i * size, (i + 1) * size) for i in range(40)]
    assert [(s.start, s.end, s.label) for s in spans[2]] == [(0, size + 1, "apache-2.0")]


def test_too_many_template_words_raise(docs, shelf):
    wide = [(" ".join(f"w{i}" for i in range(50_000)), "x")]
    with pytest.raises(ValueError):
        licenses.scan_licenses(docs, shelf, notices=wide)


def test_viterbi_finds_the_best_path():
    r = np.random.default_rng(2)
    for n in (1, 2, 6):
        scores, steps = r.normal(size=(n, 2)), r.normal(size=(2, 2))
        value = lambda p: sum(scores[i, y] for i, y in enumerate(p)) + sum(steps[a, b] for a, b in zip(p, p[1:]))
        assert value(lines.viterbi(scores, steps)) == pytest.approx(max(map(value, itertools.product((0, 1), repeat=n))))
        p, _ = lines._marginals(scores, steps)
        weights = {path: np.exp(value(path)) for path in itertools.product((0, 1), repeat=n)}
        assert p[0, 1] == pytest.approx(sum(w for path, w in weights.items() if path[0]) / sum(weights.values()))


def test_line_field_learns(spark, docs, nothing, shelf):
    rows = [(i, prose(i, 60) + ".\n" + prose(1000 + i, 60) + ".", 1) for i in range(30)] + [(100 + i, "\n".join("BUY!! NOW!! *** $$$" for _ in range(20)), 0) for i in range(30)]
    known = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 1), (5, None)], "doc_id bigint, quality int")
    field = lines.train_field(known, labels, shelf)
    got = {r.doc_id: r.quality for r in lines.judge_lines(known, field).collect()}
    assert all(got[i].content_share > 0.5 if q else got[i].content_share < 0.5 for i, _, q in rows)
    blank = lines.train_field(nothing, labels, shelf)
    out = {str(r.doc_id): r.quality for r in lines.judge_lines(docs, blank).collect()}
    assert out["1"].content_share == 1.0 and not out["6"].kept and out["8"].n_words == 0 and out["13"].n_words == 30_000


def test_chain_learns_and_needs_labels(spark, docs, nothing, shelf):
    rude = [(i, prose(i, 50) + (" idiot" if i % 2 else " stupid clown") + " " + prose(-i, 20), 1) for i in range(40)]
    clean = [(100 + i, prose(100 + i, 70), 0) for i in range(60)]
    known = spark.createDataFrame([r[:2] for r in rude + clean], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rude[::2] + rude[1::4] + clean[::2]] + [(None, 1), (100, None)], "doc_id bigint, toxic int")
    chain = toxicity.train(known, labels, shelf)
    got = {r.doc_id: r.scores for r in toxicity.score(known, chain).collect()}
    assert all(got[i].toxic == bool(y) for i, _, y in rude + clean)  # half of them were not in the sample
    assert len(chain.weights) == 3 and len(chain.weights[2]) == len(chain.words) + 3
    none = toxicity.train(docs, labels.limit(0), shelf)
    assert not any(r.scores.toxic for r in toxicity.score(docs, none).collect())
    assert toxicity.without_toxic(nothing, labels, shelf).count() == 0


def test_languages_fuse(spark, shelf):
    docs = spark.createDataFrame([(1, "the cat and the dog went there", "en"), (2, "der hund und die katze gingen dort", "de"), (3, None, "fr")], "doc_id bigint, text string, lang string")
    pages = spark.createDataFrame([(i, "http://a.x.de/1", "<html lang='de'><p>der hund und die katze</p>") for i in range(9)] + [(20, "http://a.x.de/2", None), (21, None, "<p>the dog and the cat went there</p>"), (22, "", "")], "page_id int, url string, html string")
    got = {r.page_id: r.language for r in identify(pages, docs, shelf).collect()}
    assert got[0].lang == "de" and got[20].lang == "de" and got[21].lang == "en" and got[22].host == ""
    assert identify(pages, docs.limit(0), shelf).where("language.lang = 'und'").count() == 12


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE or n in BASE])
def test_same_rows_as_sql(spark, sql, shelf, name):
    cursor = sql.execute(ORACLE.get(name) or BASE[name])
    columns = [c[0] for c in cursor.description]
    frame = QUERIES[name](spark, DATA).select(*columns)
    assert _rows(columns, [tuple(r) for r in frame.collect()]) == _rows(columns, cursor.fetchall())


def test_digests_of_the_dedup_query(spark, shelf):
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for r in QUERIES["op8_suffix_array_dedup"](spark, DATA).collect():
        assert r.n_bytes == len(docs[r.doc_id])
        if not r.n_removed:
            assert r.kept_sha256 == hashlib.sha256(docs[r.doc_id]).hexdigest()
