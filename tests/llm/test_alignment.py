"""Token alignment against plain loops over the public tokenizers."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from touchline.llm import queries
from touchline.llm.alignment import Rows, alignment_report, row_products, sides, token_links
from tests.llm.fixtures import SCHEMA, invented

A, B = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model")
ODD = [
    (900, "two  blanks and a tab\tand\nlines ", "en", "s", 0), (901, "a▁b", "en", "s", 0), (902, " lead", "en", "s", 0),
    (903, "<|endoftext|> </s> <0x41> 漢字😀 ﬁ é 　x", "en", "s", 0), (None, "same id", "en", "s", 0), (None, "same id", "en", "s", 0),
]


@pytest.fixture(scope="module")
def plain():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in printable} | {chr(256 + k): x for k, x in enumerate(sorted(set(range(256)) - set(printable)))}
    a_bytes = lambda i: bytes(byte[c] for c in a.id_to_token(i))
    b_bytes = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def tokens(text):
        """([(id, start, end)] of A, of B), both empty if they do not spell space + text."""
        if not text:
            return [], []
        out, want = [], (" " + text).encode()
        for ids, spell in ((a.encode(" " + text, add_special_tokens=False).ids, a_bytes), (b.encode(text), b_bytes)):
            at, mine = 0, []
            for i in ids:
                mine.append((i, at, at + len(spell(i))))
                at = mine[-1][2]
            if b"".join(spell(i) for i in ids) != want:
                return [], []
            out.append(mine)
        return tuple(out)

    return tokens


def brute(rows, tokens):
    found = [(r[0], *tokens(r[1])) for r in rows]
    ends = [[(x, y) for x in a for y in b if x[2] == y[2]] for _, a, b in found]
    count = Counter((x[0], y[0]) for links in ends for x, y in links)
    top = {}
    for (_, y), n in count.items():
        top[y] = max(top.get(y, 0), n)
    out = []
    for (doc, a, b), links in zip(found, ends, strict=True):
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups = [
            ",".join(str(x[0]) for x in a if lo < x[2] <= hi) + "|" + ",".join(str(y[0]) for y in b if lo < y[2] <= hi)
            for lo, hi in zip([0, *cuts], cuts, strict=False)
        ]
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        n = [count[x[0], y[0]] for x, y in links]
        out.append((doc, len(a), len(b), len(cuts), len(links), sum(k == top[y[0]] for k, (_, y) in zip(n, links, strict=True)), sum(n), sha))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [1, 3000, 8 << 20])
def test_report(spark, plain, block_bytes):
    rows = [(r[0], r[1][:1500] if r[1] else r[1], *r[2:]) for r in invented(n=20)] + ODD
    got = alignment_report(spark.createDataFrame(rows, SCHEMA).repartition(3), A, B, block_bytes=block_bytes)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, plain)


def test_links(spark, plain):
    rows = [r for r in ODD if r[0]] + [(1, None, "en", "s", 0), (2, "unaffordable hyphen-ation ünder", "de", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for kind in ("overlap", "end", "group"):
        want = []
        for doc, text, *_ in rows:
            a, b = plain(text)
            cuts = sorted({x[2] for x in a} & {y[2] for y in b})
            group = lambda t: sum(c < t[2] for c in cuts)  # noqa: B023, E731
            for i, x in enumerate(a):
                for j, y in enumerate(b):
                    n = {"overlap": max(0, min(x[2], y[2]) - max(x[1], y[1])), "end": int(x[2] == y[2]), "group": int(group(x) == group(y))}[kind]
                    want += [(doc, i, j, x[0], y[0], n)] * (n > 0)
        assert sorted(map(tuple, token_links(docs, A, B, kind, block_bytes=20).collect())) == sorted(want)
    with pytest.raises(ValueError):
        token_links(docs, A, B, "other")


def test_row_products():
    rng = np.random.default_rng(1)
    a, b = (rng.random((17, 11)) < 0.3), (rng.random((11, 23)) < 0.3)
    rows = [Rows(np.concatenate([[0], np.cumsum(m.sum(1))]), np.nonzero(m)[1], m.shape[1]) for m in (a, b)]
    want = a.astype(int) @ b.astype(int)
    for most in (1, 7, 10**6):
        got = np.zeros_like(want)
        for i, j, v in row_products(*rows, most):
            got[i, j] += v
        assert (got == want).all()
    back = rows[1].transposed().transposed()
    assert (back.first == rows[1].first).all() and (back.columns == rows[1].columns).all()


def test_encoders(plain):
    """The fast encoders give the public tokenizers' ids, on odd strings too."""
    from tokenizers import Tokenizer

    a, b = sides(A, B)
    json = Tokenizer.from_file(A)
    json.encode_special_tokens = True
    rng = random.Random(4)
    some = ["a", "the", "ing", "'s", "'S", " ", " ", "  ", "\n", "\t", " ", "é", "1", "٣", "!", "<|endoftext|>", "▁", "漢", "́", "\x00", "　", "\x85", "😀", "ﬁ"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randint(1, 12))) for _ in range(5000)] + [chr(c) + "x " + chr(c) for c in range(1, 0x3000)]
    for t in texts:
        assert a.encode(t).tolist() == json.encode(" " + t, add_special_tokens=False).ids
        assert b.encode(t).tolist() == b.model.encode(t)


def test_empty_and_extra_columns(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert alignment_report(docs, A, B).count() == 0
    clash = spark.createDataFrame([(1, "one two", 5, 6, "x")], "doc_id long, text string, block int, pair int, links string")
    assert alignment_report(clash, A, B).first()["n_links"] > 0
