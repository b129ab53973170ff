"""Each stage of the pipeline against a plain version, with null and repeated ids, ties, empty texts and an empty table."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from test_operators import plain_components
from tokenizers import Tokenizer

import corpus_pipeline as P
from ratesmith.llm import mixing, quality

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(12)
    words = lambda n: " ".join(f"w{rng.randrange(900)}" for _ in range(n))
    items = [words(14), words(30), "Short item words."]
    texts = [words(rng.randint(8, 70)) for _ in range(40)]
    texts += [texts[0], texts[1] + " more", texts[2].upper(), f"{texts[3]} {items[0]} {words(20)}", items[1], f"start, {items[1].upper()}! and {words(40)}", f"{words(12)} short, ITEM words {words(9)}", "", None, "one", "$$ !! " * 30, "### %% " * 9]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, texts[0], "en", "s0", 1), (None, None, None, None, None), (5, words(30), "en", "s1", 2), (5, texts[5], "en", "s1", len(texts[5]))]
    folder = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i < 45), 0) for i in [*range(45), 50, 51]], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), items


def table(rows):
    return Counter((r.doc_id, r.text, r.source, r.n_chars) for r in rows)


def plain_clean(text, items, k=10, most=0.5):
    """The text without passages of items; None if over `most` of its words are in some."""
    norm = lambda t: [(m[0], m.span()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))]
    windows = {tuple(w for w, _ in norm(i))[j : j + k] for i in items for j in range(max(1, len(norm(i)) - k + 1))}
    found = norm(text)
    hit = {j + d for w in windows for j in range(len(found) - len(w) + 1) if tuple(x for x, _ in found[j : j + len(w)]) == w for d in range(len(w))}
    if len(hit) > most * len(found):
        return None
    out, last = "", 0
    for j in sorted(hit):
        if j - 1 not in hit:
            end = j
            while end + 1 in hit:
                end += 1
            out, last = out + text[last : found[j][1][0]], found[end][1][1]
    return out + text[last:]


def test_stages(spark, tables):
    folder, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    stages = dict(P.STAGES)

    kept = stages["quality classifier"](spark, docs, folder)
    chosen = Counter(r.doc_id for r in quality.classify(docs, labels).collect() if r.selected)
    assert Counter(r.doc_id for r in kept.collect()) == chosen
    assert kept.columns == docs.columns
    assert not {50, 51} & set(chosen)
    assert set(range(45)) <= set(chosen)

    near = stages["n-gram Jaccard join"](spark, docs, folder).collect()
    rows = [r for r in docs.collect() if r.doc_id is not None]
    distinct = list(dict.fromkeys((r.doc_id, r.text) for r in rows))
    label = plain_components([(n, t) for n, (_, t) in enumerate(distinct)], 5, 80)
    least = {}
    for n, (i, _) in enumerate(distinct):
        least.setdefault(label[n][1], []).append(i)
    assert Counter(r.doc_id for r in near if r.doc_id is not None) == Counter(min(ids) for ids in least.values())
    assert {(r.doc_id, r.text) for r in near if r.doc_id is not None} <= set(distinct)
    assert sum(r.doc_id is None for r in near) == 2

    clean = stages["benchmark decontamination"](spark, docs, folder).collect()
    want = Counter()
    for r in docs.collect():
        text = r.text and plain_clean(r.text, items)
        if text is not None or r.text is None:
            want[(r.doc_id, text, r.source, r.n_chars if text == r.text else len(text))] += 1
    assert table(clean) == want
    assert sum(want.values()) < docs.count()

    mixed = table(stages["mixing sources to target weights"](spark, docs, folder).collect())
    assert mixed == table(mixing.mix(docs).collect())
    assert set(mixed) == set(table(docs.collect()))

    read = stages["token-ID / binary output"](spark, docs, folder).orderBy("start").collect()
    plain, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    texts = Counter((r.doc_id, r.text or "") for r in docs.collect())
    want = Counter()
    for (i, t), n in texts.items():
        ids = [*plain.encode(t, add_special_tokens=False).ids, 2]
        want[(i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += n
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in read) == want
    for r in read:
        assert r.start == start
        start += r.n_tokens
    ids = [r.doc_id for r in read]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_an_empty_table_goes_through(spark, tables):
    folder, _ = tables
    docs = spark.createDataFrame([], COLUMNS)
    for name, stage in P.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() == 0, name
