"""Chosen-path near duplicates against all pairs: chains, large groups of near copies, a passage that all share, hard cases."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.classic.dataframe import DataFrame

from ratesmith.llm import chosen_path
from ratesmith.llm.shingles import new_key

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, k=4, percent=80):
    """Component and set size of each row, by all pairs."""
    sets = []
    for i, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set())
    known = [n for n, (i, _) in enumerate(rows) if i is not None and sets[n]]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for at, x in enumerate(known):
        for y in known[:at]:
            both = len(sets[x] & sets[y])
            if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                root[top(x)] = top(y)
    least = {}
    for x in known:
        least[top(x)] = min(rows[x][0], least.get(top(x), rows[x][0]))
    return sorted(((i, len(sets[n]), least[top(n)] if n in known else i) for n, (i, _) in enumerate(rows)), key=str)


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, sig string, node int").repartition(3)
    out = chosen_path.near_duplicates(df, **more)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got = out.collect()
    assert all(r.kept == (r.doc_id is None or r.component_id == r.doc_id) for r in got)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str)


def changed(rng, words, n):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = f"c{rng.randrange(10**6)}"
    return words


def corpus(rng, families, passage=None):
    out = []
    for _ in range(families):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(30, 200))]
        for _ in range(rng.randint(1, 6)):
            base = changed(rng, base, rng.randint(0, max(1, len(base) // 40)))  # a chain: each is near the one before
            out.append(" ".join(base[: len(base) // 2] + (passage or []) + base[len(base) // 2 :]))
    return out


def test_components_as_by_all_pairs(spark):
    rng = random.Random(1)
    texts = corpus(rng, 60) + ["", " \n\t", "one", "ONE", "one two three", "a b c d e", "a b c d e f", "é ü ß 漢字", "same " * 50, "same " * 60, " ".join(f"w{rng.randrange(90)}" for _ in range(20_000))]
    rows = list(enumerate(texts)) + [(500, None), (501, None), (None, texts[0]), (None, None), (3, texts[4]), (3, texts[4]), (3, texts[9])]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows, k=5, percent=90) == plain(rows, 5, 90)


def test_large_nodes_branch(spark, monkeypatch):
    for name, value in (("LEAF", 12), ("MINOR", 45), ("GROUP_ROWS", 50), ("CLUSTER_ROWS", 20)):
        monkeypatch.setattr(chosen_path, name, value)
    rng = random.Random(2)
    passage = [f"p{i}" for i in range(60)]
    base = [f"b{i}" for i in range(120)]
    texts = corpus(rng, 40, passage) + [" ".join(changed(rng, base, rng.randint(1, 3))) for _ in range(60)] + [" ".join(changed(rng, base, 5)) for _ in range(40)]
    rows = list(enumerate(texts))
    assert run(spark, rows) == plain(rows)


def test_pairs_at_the_threshold_are_found(spark):
    rng, rows = random.Random(3), []
    for i in range(300):  # 40 shingles, of which 8 of both together aren't shared: 36 / 44 and, with one more, 35 / 45
        base = [f"w{rng.randrange(10**6)}" for _ in range(43)]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join([*base[: -4 - i % 2], *(f"c{rng.randrange(10**6)}" for _ in range(4 + i % 2))]))]
    got = run(spark, rows)
    assert got == plain(rows) and len({c for _, _, c in got}) == 450


def test_signatures_agree_as_often_as_sets_are_alike():
    rng = random.Random(4)
    base = [f"w{i}" for i in range(2000)]
    texts = [" ".join(base), " ".join(changed(rng, base, 100))]
    share = []
    for _ in range(20):
        key = new_key()
        fps, edge, _ = chosen_path._shingle_sets(pa.array(texts), 4, key)
        a, b = chosen_path.signatures(fps, edge, key)
        share.append((a == b).mean())
    x, y = (set(fps[edge[i] : edge[i + 1]].tolist()) for i in range(2))
    assert abs(np.mean(share) - len(x & y) / len(x | y)) < 0.03


def test_empty_table_and_low_threshold(spark):
    assert run(spark, []) == []
    with pytest.raises(ValueError):
        run(spark, [], percent=50)


def test_large_cluster_without_links_is_compared_by_bits(monkeypatch):
    """Pairs just under the threshold pass the signatures; each of them was an intersection of its own."""
    key, rng = b"k" * 16, np.random.default_rng(3)
    texts = []
    for i in range(300):
        w = [f"w{x}" for x in range(200)]
        for x in rng.choice(196, 6 if i % 3 else 1, replace=False):
            w[x] = f"o{i}x{x}"
        texts.append(" ".join(w))
    fps, edge, _ = chosen_path._shingle_sets(pa.array(texts), 4, key)
    sets = [set(fps[x:y].tolist()) for x, y in zip(edge[:-1], edge[1:], strict=True)]
    rid = np.arange(len(texts))
    for home in (np.ones(len(texts), bool), rid < 40):
        calls, plain = [], np.intersect1d
        monkeypatch.setattr(np, "intersect1d", lambda *a, **k: calls.append(1) or plain(*a, **k))  # noqa: B023
        rows = pa.table({"group": rid * 0, "cluster": rid * 0, "rid": rid, "label": rid, "home": home, "text": texts})
        got = chosen_path._confirmed(4, 80, key)((), rows)
        assert len(calls) < len(texts)
        want = [(i, j) for i in rid for j in rid[i + 1 :] if (home[i] or home[j]) and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
        assert 100 < len(want) < len(texts) ** 2 / 4
        label = lambda pairs: chosen_path._roots(len(texts), *(np.array(x, np.int64) for x in zip(*pairs, strict=True))).tolist()
        assert label(zip(got["a"].to_pylist(), got["b"].to_pylist(), strict=True)) == label(want)


def test_sets_that_have_met_in_a_node_do_not_meet_in_the_next():
    """A large group is in as many nodes as there are trees and branches; all its pairs were compared in each."""
    rng = np.random.default_rng(5)
    family = rng.integers(1, 1 << 32, (2, chosen_path.COORDINATES), dtype=np.uint64).astype("<u4")
    rows = [(node, rid, family[int(rid >= 20)]) for node, many in ((7, 40), (8, 41)) for rid in range(many)]  # set 40 is only in node 8
    node, rid, sig = zip(*rows, strict=True)
    whole = [[7] if n == 8 and r < 40 else [] for n, r in zip(node, rid, strict=True)]
    columns = {"group": 0, "block": 0, "n": 50, "home": True}
    t = pa.table({"node": pa.array(node, pa.int64()), "rid": pa.array(rid, pa.int64()), "label": pa.array(rid, pa.int64()), "sig": [s.tobytes() for s in sig], "earlier": pa.array(whole, pa.list_(pa.int64())), **{k: [v] * len(rows) for k, v in columns.items()}})
    got = chosen_path._near(80)((), t).to_pylist()
    assert sorted(r["rid"] for r in got) == sorted([*range(40), *range(20, 41)])
    assert len({r["cluster"] for r in got}) == 3


def test_each_set_is_fetched_once_for_all_its_nodes(spark, monkeypatch):
    """A join of memberships with signatures or texts made a row for each node, block and cluster that a set is in."""
    for name, value in (("LEAF", 12), ("MINOR", 45), ("GROUP_ROWS", 50), ("CLUSTER_ROWS", 20)):
        monkeypatch.setattr(chosen_path, name, value)
    plain_join, made = DataFrame.join, []

    def join(self, other, on=None, how=None):
        out = plain_join(self, other, on, how)
        if on == "rid" and how is None:
            made.append((out.count(), out.select("rid").distinct().count()))
        return out

    monkeypatch.setattr(DataFrame, "join", join)
    rng = random.Random(6)
    base = [f"b{i}" for i in range(120)]
    rows = list(enumerate(corpus(rng, 20) + [" ".join(changed(rng, base, rng.randint(1, 8))) for _ in range(90)]))
    assert run(spark, rows) == plain(rows)
    assert len(made) > 3 and all(n == sets for n, sets in made)
