"""Alignment against both libraries on whole texts, one document at a time."""

import random
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ratesmith.llm import alignment

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
ALPHABET = {}
_next = 256
for _x in range(256):
    if 0x21 <= _x <= 0x7E or 0xA1 <= _x <= 0xAC or 0xAE <= _x <= 0xFF:
        ALPHABET[chr(_x)] = _x
    else:
        ALPHABET[chr(_next)] = _x
        _next += 1


def tokens(text):
    """[(id, bytes)] of both sides, empty where they don't give the text back."""
    if not text:
        return [], []
    e = A.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(ALPHABET[c] for c in A.id_to_token(i))) for i in e.ids]
    b = [(i, bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode()) for i in B.encode(text)]
    want = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else ([], [])


def spans(side):
    out, at = [], 0
    for i, x in side:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def plain(texts):
    docs = [tuple(map(spans, tokens(t))) for t in texts]
    links = [[(i, j) for i, s, e in a for j, u, v in b if s < v and u < e] if len(a) < 3000 else None for a, b in docs]
    count = Counter(x for own in links for x in own)
    best = defaultdict(int)
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    out = []
    for (a, b), own in zip(docs, links):
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = [",".join(str(i) for i, s, e in a if x < e <= y) + "|" + ",".join(str(i) for i, s, e in b if x < e <= y) for x, y in zip([0, *cuts], cuts)]
        out.append((len(a), len(b), len(cuts), len(own), sum(count[x] == best[x[1]] for x in own), sum(count[x] for x in own), ";".join(groups)))
    return out


def test_alignment_as_by_both_libraries(spark, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE", 4000)
    rng = random.Random(1)
    made = [" ".join("".join(rng.choices("abcdeéñß,.'&1 ", k=rng.randint(1, 9))) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    texts = made + [
        None, "", " ", "  ", "a  b", "  a", "a ", "a\n b\n\n  c \t d", "<|endoftext|> <s> </s> <unk> <0x41>", "don't we'll it's", "x▁y", "a  b 　 c", "日本語 テスト 漢字", "é è Ü ß", "é x", "\x00 a\x00b", "a  b",
        "the " * 300, "\U0001f600 ok \U0001f600", "x" * 3000, "ﬁ ½ ①", "a" + " " * 40 + "b", "\n\n\n", "ends with é é", "1234 5678,90", "á" * 50, "É À", "\x85 \x1c a \x1d b",
    ]
    rows = [(i if i % 7 else None, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id int, text string, groups string").repartition(3)
    got = alignment.align(df).collect()
    assert len(got) == len(rows)
    want = sorted((str(r[0]), *x) for r, x in zip(rows, plain(texts)))
    assert sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in got) == want
    assert sum(x[0] for x in plain(texts)) > 1000 and [x for t, x in zip(texts, plain(texts)) if t == "x▁y"][0][0] == 0


def test_repeated_rows_and_an_empty_table(spark, monkeypatch):
    monkeypatch.setattr(alignment, "HELD_PAIRS", 4)
    texts = ["one two three"] * 3 + ["two three four five", "one"]
    got = alignment.align(spark.createDataFrame([(7, t) for t in texts], "doc_id long, text string")).orderBy(F.length("groups"), "groups").collect()
    assert sorted(tuple(r)[1:] for r in got) == sorted(plain(texts))
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert [tuple(r)[1:] for r in alignment.align(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect()] == [(0,) * 6 + ("",)] * 2
