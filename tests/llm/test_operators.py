"""The operators against plain versions: nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from ratesmith.llm import html_extract, license_scan, mixing, quality, simple8b, substring_dedup, token_output, topk_search, warc
from ratesmith.llm.decontaminate import decontaminate
from ratesmith.llm.jaccard_join import linked_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, hits string, bucket int, set string, spans int, weight string"


def words_of(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = [words_of(rng, rng.randint(20, 90), 4000) for _ in range(25)]
    out = [" ".join(b) for b in base]
    for b in base[:8]:  # near copies, a chain of them, passages, exact copies
        near = list(b)
        near[len(b) // 2] = "changed"
        again = list(near)
        again[3] = "twice"
        out += [" ".join(near), " ".join(again), " ".join(words_of(rng, 10) + b[2:18] + words_of(rng, 5)), " ".join(b).upper()]
    out += [out[0]] * 3 + ["", "   \n\t", "one", "one two three", "one two three", "é ü\x00 ß 漢字 a b", "same " * 40, " ".join(words_of(rng, 6000)), "x" * 5000]
    return list(enumerate(out)) + [(500, None), (501, None), (None, out[1]), (None, None)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", f"s{(i or 0) % 3 if (i or 0) % 4 else 0}", len(t or ""), "h", 1, "s", 2, "w") for i, t in texts]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], schema)


def test_substring_dedup(spark, docs, texts):
    first = {}
    known = {i: WORD.findall(t or "") for i, t in texts if i is not None}
    for i in sorted(known):
        for j in range(len(known[i]) - 12):
            first.setdefault(tuple(known[i][j : j + 13]), i)
    want = {}
    for i, w in known.items():
        gone = {j + d for j in range(len(w) - 12) if first[tuple(w[j : j + 13])] < i for d in range(13)}
        want[i] = (len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest())
    rows = substring_dedup.sha256_of(substring_dedup.dedup_substrings(docs)).collect()
    assert len(rows) == len(texts)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows if r.doc_id is not None} == want
    assert any(n for _, n, _ in want.values())
    assert substring_dedup.dedup_substrings(empty(spark)).count() == 0


def plain_components(texts, k, percent):
    sets = {}
    for i, t in texts:
        if i is not None:
            w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
            sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    label = {i: i for i in sets}
    pairs = [(i, j) for i in sets for j in sets if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    for _ in sets:
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    return {i: (len(sets[i]), label[i]) for i in sets}


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_jaccard_join(spark, docs, texts, k, percent):
    rows = linked_components(docs, k, percent).collect()
    assert len(rows) == len(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None} == plain_components(texts, k, percent)
    assert linked_components(empty(spark), k, percent).count() == 0


def test_decontaminate(spark, docs, texts):
    by_id = dict((i, t) for i, t in texts if i is not None)
    items = [(1, " ".join(by_id[2].split()[3:16])), (10, "W1!! one, TWO three"), (2, None), (3, ""), (4, by_id[5]), (5, by_id[5]), (None, "漢字")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    windows = defaultdict(set)
    norm = lambda t: ALNUM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    for i, t in items:
        w = norm(t)
        for j in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[j : j + 10])].add(i)
    rows = {r.doc_id: r for r in decontaminate(docs, bench).collect() if r.doc_id is not None}
    for i, t in by_id.items():
        w, hit, found = norm(t), set(), set()
        for win, ids in windows.items():
            for j in range(len(w) - len(win) + 1):
                if tuple(w[j : j + len(win)]) == win:
                    hit |= set(range(j, j + len(win)))
                    found |= {str(x) for x in ids if x is not None}
        assert (rows[i].n_words, rows[i].n_hit, rows[i]["items"]) == (len(w), len(hit), sorted(found)), i
    assert decontaminate(empty(spark), bench).count() == 0
    assert {r.n_hit for r in decontaminate(docs, empty(spark, "item_id long, text string")).collect()} == {0}


def test_token_files(spark, docs, texts, tmp_path):
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    token_output.write_tokens(docs, str(tmp_path / "t"))
    rows = token_output.read_tokens(spark, str(tmp_path / "t")).collect()
    start = sum(r.n_tokens for r in rows if r.doc_id is None)
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows if r.doc_id is not None}
    for i, t in sorted((i, t) for i, t in texts if i is not None):
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 2]
        assert found[i] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), i
        start += len(ids)
    assert len(rows) == len(texts)


@pytest.mark.parametrize("values", [[], [0], [0] * 700, [2**16] * 5, list(range(3000)), [1, 2**40, 3], [49407, 0, 1] * 100])
def test_simple8b_round_trip(values):
    values = np.array(values, np.uint64)
    words, offsets = simple8b.encode(values)
    assert (simple8b.decode(words, offsets, len(values)) == values).all()


def test_warc(spark, tmp_path):
    big, magic = "<p>" + "y" * 1200, "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 30
    pages = [(1, "http://a/", big), (2, "http://b/", big), (3, None, "small"), (4, "http://d/", "small"), (5, "http://e/\r\nX: 1", None), (6, "", ""), (7, "http://g/", magic), (8, "u", "é" * 600), (9, "u", big)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, payload string").repartition(2)
    warc.write_warc(df, str(tmp_path / "w"))
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_warc(spark, str(tmp_path / "w")).collect()}
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    want = {i: (len((t or "").encode()), sha(t), "response", None) for i, _, t in pages}
    want[1], want[2] = ((*want[i][:2], "revisit", 9) for i in (1, 2))
    assert got == want


def test_topk(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32) * (1 + i % 7)]) for i in range(400)]
    rows[7] = (7, rows[50][1])
    rows += [(1000, None), (1001, [None] * 8), (1002, [float("nan")] * 8), (1003, []), (None, rows[1][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, bucket int")
    got = defaultdict(list)
    for r in sorted(topk_search.top_k(df).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    v = {i: np.floor(256 * np.array(x, np.float32).astype(float)).astype(int) for i, x in rows[:400]}
    want = {q: [(n + 1, i, s) for n, (s, i) in enumerate(sorted(((int(v[q] @ v[i]), i) for i in v if i != q), key=lambda x: (-x[0], x[1]))[:5])] for q in range(0, 400, 50)}
    assert got == want
    assert topk_search.top_k(df.where("vec_id = 0")).count() == 0


def test_license_scan(spark, docs):
    extra = [(900, "some prose here\nReleased under the MIT License.\nmore prose"), (901, "word " * 300 + "\nLicensed under CC BY-NC 4.0."), (902, "This program is licensed under the GNU Lesser General Public License, version 2.1"), (903, "He studied at MIT and had a license to drive"), (904, None), (905, ""), (906, "word " * 500)]
    df = docs.select("doc_id", "text", "spans").unionByName(spark.createDataFrame([(i, t, 0) for i, t in extra], "doc_id long, text string, spans int"))
    rows = license_scan.scan_licenses(df).collect()
    found = {r.doc_id: [s.family for s in r.spans] for r in rows}
    assert len(rows) == df.count()
    assert [found[i] for i, _ in extra] == [["MIT"], ["CC-BY-NC"], ["LGPL"], [], [], [], []]
    assert not any(f for i, f in found.items() if i is not None and i < 900)


def test_quality_separates_and_keeps(spark):
    rng = random.Random(1)
    good = lambda: " ".join(words_of(rng, 60, 200)).capitalize() + "."
    bad = lambda: " ".join(f"{rng.choice('!$%#')}{rng.randrange(99)}ZZ" for _ in range(60))
    rows = [(i, good() if i % 3 else bad()) for i in range(300)] + [(300, None), (301, ""), (None, good())]
    df = spark.createDataFrame([(i, t, 0.0) for i, t in rows], "doc_id long, text string, importance double")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(0, 300, 2)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.selected for r in quality.classify(df, labels).collect()}
    held = [i for i in range(1, 300, 2)]
    assert sum(got[i] == bool(i % 3) for i in held) / len(held) > 0.95
    assert quality.select_documents(df, labels).columns == df.columns
    assert all(r.selected for r in quality.classify(df, empty(spark, "doc_id long, quality int, toxic int")).collect())
    assert quality.classify(df.where("false"), labels).count() == 0


def test_mixing_keeps_every_document_and_the_budget(spark, docs, texts):
    rows = mixing.mix(docs).collect()
    times = Counter((r.doc_id, r.text) for r in rows)
    assert set(times) == set(texts)
    tokens, got = Counter(), Counter()
    for r in docs.collect():
        tokens[r.source] += len(WORD.findall(r.text or ""))
    for r in rows:
        got[r.source] += len(WORD.findall(r.text or ""))
    assert all(got[s] <= mixing.MAX_REPEATS * tokens[s] + 1e-6 and got[s] >= tokens[s] for s in tokens)
    low, high = (mixing.plan(docs, target_entropy=h).orderBy("source").collect() for h in (0.9, 1.09))
    entropy = lambda p: -sum(r.weight * np.log(r.weight) for r in p if r.weight)
    assert entropy(high) == pytest.approx(1.09, abs=1e-3) or entropy(high) < 1.09
    assert entropy(low) <= entropy(high)
    assert mixing.mix(empty(spark)).count() == 0


def test_html_extraction(spark):
    page = lambda i, body: f"<html><head><title>t</title><style>p {{}}</style></head><body><nav class='menu'><a href='/'>Home</a></nav><div class='main c{i}'>{body}</div><footer>all rights</footer><script>var x = '<p>no</p>';</script></body></html>"
    body = "<p>First   &amp; second sentence of an article, which is long.</p>\n<p>Another paragraph with <b>bold</b> words in it, long too.</p>"
    rows = [(i, f"http://h.example/{i}", page(i, body)) for i in range(6)] + [(10, "http://h.example/x", None), (11, None, ""), (12, "::", "<p>unclosed <b>text &#233;")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    want = "First & second sentence of an article, which is long.\nAnother paragraph with bold words in it, long too."
    assert [got[i] for i in range(6)] == [want] * 6
    assert (got[10], got[11]) == ("", "")
    assert len(got) == len(rows)
    assert html_extract.extract(df.where("false")).count() == 0


def test_pipeline_stages(spark):
    d = "/root/testdata/sf0.001"
    now = spark.read.parquet(f"{d}/documents.parquet")
    columns, sizes = now.columns, [now.count()]
    for name, stage in corpus_pipeline.STAGES:
        if name == "n-gram Jaccard join":
            before = [(r.doc_id, r.text) for r in now.collect()]
        now = stage(spark, now, d)
        sizes.append(now.count())
        if name == "n-gram Jaccard join":
            assert {r.doc_id for r in now.collect()} == {label for _, label in plain_components(before, 5, 80).values()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.columns == columns
    rows = now.orderBy("start").collect()
    assert sizes[0] >= sizes[1] >= sizes[2] >= sizes[3] <= sizes[4] == sizes[5]
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(len(rows))]
