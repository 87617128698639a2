"""Spelling variants against edit distances of all pairs."""

import random
import re
import zlib
from itertools import combinations

import pytest

from starweave.llm import spelling


def _one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return any(a[:k] + a[k + 1 :] == b for k in range(len(a)))


def _random_words(rng, number, letters="abcé", longest=9):
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(longest))) for _ in range(number)})


def test_scan_of_a_sorted_list():
    rng = random.Random(5)
    for letters in ("ab", "abcdefé"):
        for number in (0, 1, 2, 30, 250):
            words = _random_words(rng, number, letters)
            got = list(spelling.close_pairs(words))
            assert len(got) == len(set(got))
            assert set(got) == {(i, j) for i, j in combinations(range(len(words)), 2) if _one_edit(words[i], words[j])}


def test_scan_skips_prefixes(monkeypatch):
    """What shares a prefix that is two edits away is passed over together."""

    class Counted(list):
        steps = 0

        def __getitem__(self, k):
            Counted.steps += 1
            return super().__getitem__(k)

    monkeypatch.setattr(spelling, "_NEXT", Counted(spelling._NEXT))
    words = sorted(["aaaa", *(f"zz{k:04d}" for k in range(1000))])
    assert not [p for p in spelling.close_pairs(words) if p[0] == 0]
    alone, Counted.steps = Counted.steps, 0
    list(spelling.close_pairs(words[1:]))
    assert alone - Counted.steps <= 2


@pytest.mark.parametrize("crowd", [200, 6, 1])
def test_near_words(spark, crowd):
    """However small the groups are made, each pair is found, once a way."""
    words = [w for w in _random_words(random.Random(crowd), 300) if w]
    rows = [(w, k + 1) for k, w in enumerate(words)]
    got = spelling.near_words(spark.createDataFrame(rows, "word string, n long"), crowd).collect()
    n = dict(rows)
    assert all(r.n == n[r.word] and r.near_n == n[r.near] for r in got)
    assert sorted((r.word, r.near) for r in got) == sorted((a, b) for a in words for b in words if _one_edit(a, b))


def test_crowded_prefix_is_halved(spark):
    """Words that all begin alike end up in small groups, whose rows grow with the words only."""
    rng = random.Random(1)
    sizes = []
    for number in (400, 800):
        words = {"common" + "".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(number)}
        found = spelling.groups(spark.createDataFrame([(w, 1) for w in words], "word string, n long"), 50)
        held = found.groupBy("m", "lo", "hi", "head", "tail").count()
        assert held.agg({"count": "max"}).first()[0] <= 50
        sizes.append(found.count())
    assert sizes[1] < 3 * sizes[0]


def _want(rows):
    count = {}
    for doc, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                count[run] = count.get(run, 0) + 1
    count = {w: n for w, n in count.items() if n >= 3}
    near = {w: [v for v in count if _one_edit(w, v)] for w in count}
    form = {}
    for w in count:
        best = min(near[w], key=lambda v: (-count[v], v), default=None)
        form[w] = best if best and count[best] >= 2 * count[w] else None
    out = {}
    for w in count:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, count[w], len(near[w]), count.get(form[w]))
    return out


def test_variants(spark):
    rng = random.Random(9)
    letters, weights = "abÉé÷x", [9, 5, 2, 2, 1, 1]
    words = ["".join(rng.choices(letters, weights, k=rng.randrange(4, 8))) for _ in range(150)]
    words += ["colour", "Colour", "color", "colors", "coloring", "straße", "ñandúes"]
    chance = [1 / (k + 1) for k in range(len(words))]
    rows = [(k * 7 - 50, " ".join(rng.choices(words, chance, k=rng.randrange(120)))) for k in range(60)]
    rows += [(1, None), (2, ""), (3, "12 ... 日本"), (4, "y" * 70_000 + " " + "color " * 30_000), (5, rows[7][1]), (5, rows[7][1]), (None, rows[8][1])]
    rows.append((6, "chain " * 60 + "chains " * 25 + "chainsx " * 8))
    named = [(*r, "w", 3, "f") for r in rows]
    docs = spark.createDataFrame(named, "doc_id long, text string, word string, n long, form string").repartition(3)
    got = spelling.variants(spelling.vocabulary(docs)).collect()
    want = _want(rows)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want and len(got) == len(want)
    assert any(f and root != f for f, root, *_ in want.values())


def test_roots_of_a_long_chain(spark):
    rows = [(f"w{k:03d}", f"w{k + 1:03d}") for k in range(100)] + [("a", "w050")]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(rows, "word string, form string")).collect()}
    assert got == {w: "w100" for w, _ in rows}


def test_no_words(spark):
    for rows in ([], [(1, None), (2, "rare words")]):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        assert spelling.variants(spelling.vocabulary(docs)).count() == 0
