"""Cross-tokenizer alignment against whole texts encoded at once."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from starweave.llm import alignment
from starweave.llm.queries import piece_path, tokenizer_path

PARTS = [" ", "  ", "\n", "\t", "\r\n", "\xa0", "\x85", "\x1c", " a", " the", "'s", " don't", "!", "??", "é", " 日本", "́", "<s>", "<0x41>"]
PARTS += [" <|endoftext|>", "1", "_", "\0", " " + "x" * 70, ",", " b.", "🙂", " running", "ﬁ"]


@pytest.fixture(scope="module")
def tools():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path())
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=piece_path())


def _spelled(tools, text):
    """(ids, bytes) of both sides of a whole text."""
    a, b = tools
    alphabet = alignment.byte_alphabet()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    tokens_a = [bytes(alphabet[c] for c in a.id_to_token(k)) for k in ids_a]
    ids_b = b.encode(text)
    tokens_b = []
    for k in ids_b:
        piece = b.id_to_piece(k)
        tokens_b.append(bytes([int(piece[3:5], 16)]) if b.is_byte(k) else piece.replace("▁", " ").encode())
    return ids_a, tokens_a, ids_b, tokens_b


def _plain(tools, text):
    """(n_a, n_b, groups, links) by comparing all byte ranges."""
    if not text:
        return 0, 0, [], []
    ids_a, tokens_a, ids_b, tokens_b = _spelled(tools, text)
    whole = (" " + text).encode()
    if b"".join(tokens_a) != whole or b"".join(tokens_b) != whole:
        return 0, 0, [], []
    ends_a, ends_b = np.cumsum([len(t) for t in tokens_a]), np.cumsum([len(t) for t in tokens_b])
    cuts = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
    groups, last = [], 0
    for cut in cuts:
        one = [str(k) for k, e in zip(ids_a, ends_a) if last < e <= cut]
        two = [str(k) for k, e in zip(ids_b, ends_b) if last < e <= cut]
        groups.append(",".join(one) + "|" + ",".join(two))
        last = cut
    starts_a, starts_b = ends_a - [len(t) for t in tokens_a], ends_b - [len(t) for t in tokens_b]
    links = []
    for k, s, e in zip(ids_a, starts_a, ends_a):
        links += [(k, ids_b[j]) for j in np.flatnonzero((starts_b < e) & (ends_b > s))]
    return len(ids_a), len(ids_b), groups, links


def _want(tools, rows):
    plain = [_plain(tools, r[1]) for r in rows]
    held = Counter(pair for *_, links in plain for pair in set(links))
    most = {}
    for (a, _), n in held.items():
        most[a] = max(n, most.get(a, 0))
    out = []
    for (doc, *_), (n_a, n_b, groups, links) in zip(rows, plain):
        best = sum(held[p] == most[p[0]] for p in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((doc, n_a, n_b, len(groups), len(links), best, sum(held[p] for p in links), digest))
    return sorted(out, key=str)


def _rows():
    rng = random.Random(4)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(30))) for _ in range(150)]
    texts += [None, "", " ", "\n", "a", "▁", "a▁b", "same words here"] + ["same words here"] * 30
    texts += [" ".join(rng.choices(["alpha", "the", "of", "naïve", "x1", "end."], k=500)), "z" * 3000]
    return [(k * 5 - 30, t, "c", 7, "r") for k, t in enumerate(texts)] + [(0, "the", "c", 7, "r"), (0, "the", "c", 7, "r"), (None, "of", "c", 7, "r")]


COLUMNS = "doc_id long, text string, codes string, radix int, run string"


@pytest.mark.parametrize("radices,run_links,fan", [(3, alignment.RUN_LINKS, 64), (7, 200, 2)])
def test_alignment(spark, tools, radices, run_links, fan):
    rows = _rows()
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
    got = alignment.aligned(docs, tokenizer_path(), piece_path(), radices, run_links, fan).collect()
    assert sorted(map(tuple, got), key=str) == _want(tools, rows)


def test_whole_texts_give_the_same(tools):
    tool = alignment.Aligner(tokenizer_path(), piece_path(), 4)
    assert tool.cuts
    for _, text, *_ in _rows():
        if text and len(text) < 5000:
            units = tool.units(text)
            tool.learn({*units, text})
            parts, whole = [tool.known[u] for u in units], tool.known[text]
            assert (whole is None) == (None in parts)
            if whole:
                assert whole[:3] == tuple(sum(p[k] for p in parts) for k in range(3))
                assert whole[3] == b"".join(p[3] for p in parts) and whole[4] == ";".join(p[4] for p in parts)


def test_a_vocabulary_that_joins_words_is_not_cut():
    tool = alignment.Aligner(tokenizer_path(), piece_path(), 4)
    pieces = [tool.b.id_to_piece(k) for k in range(tool.size_b)]
    assert tool._allows_cuts(pieces) and not tool._allows_cuts([*pieces, "of▁the"])
    tool.cuts = False
    assert tool.units("a b") == ["a b"]


def test_heap_merge():
    rng = np.random.default_rng(1)
    runs = [(np.unique(rng.integers(0, 50, rng.integers(0, 40))), None) for _ in range(9)]
    runs = [(c, rng.integers(1, 9, len(c))) for c, _ in runs]
    want = Counter()
    for c, n in runs:
        for code, count in zip(c.tolist(), n.tolist()):
            want[code] += count
    codes, counts = alignment.heap_merged(runs)
    assert list(zip(codes.tolist(), counts.tolist())) == sorted(want.items())


def test_no_rows(spark):
    for rows in ([], [(1, None), (2, ""), (3, "▁")]):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = alignment.aligned(docs, tokenizer_path(), piece_path(), 3).collect()
        assert sorted(tuple(r) for r in got) == [(k, 0, 0, 0, 0, 0, 0, "") for k, _ in rows]
