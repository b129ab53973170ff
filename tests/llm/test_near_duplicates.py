"""The pipeline's near-duplicate stage on repeated and missing doc_ids, against a plain version."""

import random

import corpus_pipeline


def plain(rows):
    """Rows that stay: all without doc_id, and of each component of texts the least (doc_id, text) by doc_id."""
    known = sorted({r for r in rows if r[0] is not None}, key=lambda r: r[0])
    sets = [{tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if (w := (t or "").lower().split()) else set() for _, t in known]
    label = list(range(len(known)))
    for _ in known:
        for i in range(len(known)):
            for j in range(i):
                if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    return known, label


def test_repeated_and_missing_ids(spark):
    rng = random.Random(3)
    texts = [[f"w{rng.randrange(4000)}" for _ in range(80)] for _ in range(9)]
    near = lambda i: " ".join([*texts[i][:79], "changed"])
    t = [" ".join(x) for x in texts]
    rows = [(1, t[0]), (1, t[1]), (2, near(0)), (2, t[2]), (3, t[3]), (3, t[3]), (4, t[4]), (4, near(4)), (5, ""), (5, ""), (5, None), (6, t[5]), (7, t[5]), (7, t[6]), (7, near(1)), (None, t[0]), (None, t[0]), (None, near(7))]
    df = spark.createDataFrame([(i, x, n) for n, (i, x) in enumerate(rows)], "doc_id long, text string, n int").repartition(3)
    out = corpus_pipeline.near_duplicates(spark, df, "")
    assert out.columns == df.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    known, label = plain(rows)
    assert sorted(x for i, x in got if i is None) == sorted(x for i, x in rows if i is None)
    kept = [r for r in got if r[0] is not None]
    of = dict(zip(known, label, strict=True))
    assert len(kept) == len(set(kept)) == len(set(label))
    assert {of[r]: r[0] for r in kept} == {x: min(r[0] for r, y in of.items() if y == x) for x in set(label)}
    assert {(1, t[1]), (2, t[2]), (7, t[6])} <= set(kept)
