"""Every operator against a brute-force version, over rows that are null, empty, long, tied or repeated."""

import hashlib
import random
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starweave.llm import (
    components,
    hilbert,
    nb_linear,
    odd_sketches,
    positional_index,
    recompression,
    spotsigs,
    token_files,
    url_rules,
    warc_segments,
    water_filling,
)
from starweave.llm.common import ranked, small_batches
from starweave.llm.queries import RULES, tokenizer_path

# extra columns whose names clash with those the operators use inside
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid long, n string, size string, _at long"


def _texts(seed=5):
    rng = random.Random(seed)
    words = ["the", "of", "and", *(f"w{k}" for k in range(60)), "Élan", "x" * 300]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base, passage = say(120), say(40)
    texts = [base, base, base + " tail", base.replace("w1 ", "w2 ", 1).upper(), None, "", "  \n\t ", "one", "one two"]
    texts += [say(30) + " " + passage + " " + say(5), passage + "\n" + say(50), "a " * 90, "a b c " * 40, say(6000)]
    near = base.split()
    for k in range(25):  # near copies, and texts just too far from them
        copy = list(near)
        for _ in range(k):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    return texts


@pytest.fixture(scope="module")
def rows():
    out = []
    for k, text in enumerate(_texts()):
        source = [None, "s1", "s2", "s3", ""][k % 5]
        out.append((k * 3, text, None if k % 7 == 0 else "en", source, None, 1, "n", None, 5))
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def odd(spark, rows):
    """Null ids, and rows given twice."""
    return spark.createDataFrame([*rows[:8], *rows[:4], (None, *rows[0][1:]), (None,) * 9], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _words(text):
    return (text or "").encode().split()


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 540)] + [(7, 7), (3, 9), (9, 3)]
    rng.shuffle(edges)
    got = {r.id: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 100 for k in range(100, 161)}, **{k: 500 for k in range(500, 540)}, 3: 3, 9: 3}


def test_ranked(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    got = [(r.k, r.id) for r in ranked(df, ["k", "id"], "at").orderBy("at").collect()]
    assert got == sorted(got) and len(got) == 1000


def _near(rows, size):
    sets = {}
    for doc, text, *_ in rows:
        w = [x.lower() for x in _words(text)]
        sets[doc] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    top = {d: d for d in sets}
    change = True
    while change:
        change = False
        for a in sets:
            for b in sets:
                both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
                if either and 100 * both >= 80 * either and top[a] < top[b]:
                    top[b], change = top[a], True
    return {d: (len(sets[d]), top[d], top[d] == d) for d in sets}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(docs, rows, size):
    got = odd_sketches.near_duplicates(docs, size).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == _near(rows, size)


def test_crossing_pairs_of_a_group(spark):
    """Two large groups of near copies that are close to each other stay apart, and stay whole."""
    rng = random.Random(4)
    base = [f"b{k}" for k in range(200)]
    far = base[:150] + [f"c{k}" for k in range(50)]
    rows = []
    for k in range(120):
        copy = list(base if k % 2 else far)
        for _ in range(rng.randrange(9)):
            copy[rng.randrange(200)] = f"e{rng.randrange(10**6)}"
        rows.append((k, " ".join(copy)))
    got = odd_sketches.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == _near(rows, 2)


def test_tokens(docs, rows, odd):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(tokenizer_path())
    start, want = 0, {}
    for doc, text, *_ in rows:
        ids = np.array([*tool.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want[doc] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    got = token_files.tokenized(docs, tokenizer_path()).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == want
    assert token_files.tokenized(odd, tokenizer_path()).count() == 14


def test_units_of_tokens():
    from tokenizers import Tokenizer

    rng, tool = random.Random(3), Tokenizer.from_file(tokenizer_path())
    bits = [" ", "  ", "\n", "\t", " \n", "\u00a0", "\u2003", "it's", "Ab", "12", ",", "<|endoftext|>", "é", "…", "a.b"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(14))) for _ in range(3000)]
    encoder = token_files.Encoder(tokenizer_path())
    for at in range(0, len(texts), 100):
        got = encoder.encode(texts[at : at + 100])
        for text, ids in zip(texts[at : at + 100], got):
            assert np.frombuffer(ids, "<u4").tolist() == tool.encode(text, add_special_tokens=False).ids, repr(text)


def test_hilbert(docs, rows, odd):
    got = hilbert.shards(docs, 6).collect()
    by = {}
    for r in got:
        text = (rows[r.doc_id // 3][1] or "").encode()
        assert (r.size, r.text_crc32) == (len(text) + 16, zlib.crc32(text))
        by.setdefault(r.shard, []).append(r.slot)
    counts = [len(v) for v in by.values()]
    assert len(got) == len(rows) and max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert hilbert.shards(odd, 3).count() == 14
    assert hilbert.spans(hilbert.shards(docs, 6)).count() == 6


def test_hilbert_sees_whole_names(spark):
    """Names that begin alike are placed like short names in the same order."""
    rows = [(k, "x" * (k // 8 * 3), f"s{k % 8}") for k in range(512)]
    short = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("lang", F.lit("en"))
    long = short.withColumn("source", F.concat(F.lit("https://www.example.org/"), "source"))
    placed = [{r.doc_id: (r.shard, r.slot) for r in hilbert.shards(df, 64).collect()} for df in (short, long)]
    assert placed[0] == placed[1]
    sources = hilbert.shards(long, 64).groupBy("shard").agg(F.countDistinct("source").alias("n")).agg(F.avg("n"))
    assert sources.first()[0] < 5  # by size alone every shard has all eight


def test_cuts_of_names(spark):
    rng = random.Random(6)
    names = [rng.choice([None, "", "https://é", *(f"https://{k}" for k in range(rng.randrange(1, 200)))]) for _ in range(999)]
    order = sorted(names, key=lambda v: (v is not None, v or ""))
    cuts = hilbert.name_cuts(spark.createDataFrame([(n,) for n in names], "source string").repartition(3), "source", 4)
    want = {order[-(-k * 999 // 16) - 1] for k in range(1, 16)}
    assert cuts == sorted(want, key=lambda v: (v is not None, v or ""))
    got = spark.createDataFrame([(n,) for n in names], "source string").select("source", hilbert.name_cell("source", cuts).alias("cell"))
    key = lambda v: (v is not None, v or "")
    assert all(r.cell == sum(key(c) <= key(r.source) for c in cuts) for r in got.collect())


def test_curve_is_a_walk():
    bits = 3
    cells = np.array(np.meshgrid(*[range(1 << bits)] * 3, indexing="ij")).reshape(3, -1)
    order = np.argsort(hilbert.curve_index(cells, bits))
    assert sorted(hilbert.curve_index(cells, bits)) == list(range(512))
    assert (np.abs(np.diff(cells[:, order], axis=1)).sum(axis=0) == 1).all()


def _cut(rows, window):
    first, want = {}, {}
    for doc, text, *_ in sorted(rows, key=lambda r: r[0]):
        w = _words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if first.setdefault(key, (doc, i)) != (doc, i):
                gone.update(range(i, i + window))
        left = b" ".join(x for i, x in enumerate(w) if i not in gone)
        want[doc] = (len(w), len(gone), hashlib.sha256(left).hexdigest())
    return want


@pytest.mark.parametrize("window", [20, 3])
def test_repeats(docs, rows, window):
    got = recompression.remove_repeats(docs, window).withColumn("sha", F.coalesce(F.sha2("kept", 256), "whole_sha256"))
    assert {r.doc_id: (r.n_words, r.n_removed, r.sha) for r in got.collect()} == _cut(rows, window)


def test_repeated_ids_are_documents(odd):
    got = recompression.remove_repeats(odd).collect()
    assert len(got) == 14 and sum(r.doc_id is None for r in got) == 2
    near = odd_sketches.near_duplicates(odd, 2).collect()
    assert len(near) == 14 and sum(r.kept for r in near if r.n_shingles) < 9


def _terms(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def test_contamination(spark, docs, rows, odd, none):
    texts = [r[1] for r in rows]
    items = [(1, " ".join(texts[9].split()[25:60])), (20, "one, TWO!"), (3, None), (4, ""), (5, "w3"), (None, "one"), (6, "not there")]
    items = [*items, (1, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = positional_index.contamination(docs, bench).collect()
    for r in got:
        w, hit, named = _terms(texts[r.doc_id // 3]), set(), set()
        for item, text in items:
            t = _terms(text)
            n = min(13, len(t))
            for k in range(len(t) - n + 1 if t else 0):
                for i in range(len(w) - n + 1):
                    if w[i : i + n] == t[k : k + n]:
                        hit.update(range(i, i + n))
                        named |= {str(item)} if item is not None else set()
        assert (r.n_words, r.n_hit, r.items) == (len(w), len(hit), sorted(named))
        assert r.contaminated == bool(hit and 20 * len(hit) >= len(w))
    assert positional_index.contamination(odd, bench).count() == 14
    assert positional_index.contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "x a p p b y"), (2, "a b"), (3, "b p p p p a")], "rid long, text string")
    asked = positional_index.phrases(spark.createDataFrame([(1, "a b")], "item_id long, text string"))
    got = {(r.rid, r.off) for r in positional_index.near_matches(docs, asked, 2).collect()}
    assert got == {(1, 2), (2, 0)}


def test_urls(spark):
    urls = [
        "http://example.org/en/12", "https://a.example.org/en/2?x=/es/", "http://Example.ORG/es/", "http://b.com/fr/x",
        "http://b.com/de/", "http://org/", "http://org", "no scheme", None, "", "http://x.com?u=http://c/de/", "x://é.com/de/é#f",
        "http://notexample.org/es/", "http://b.com/de/", "http:///de/",
    ]
    df = spark.createDataFrame([(k, u, "extra", "h") for k, u in enumerate(urls)], "page_id long, url string, rule_host string, won2 string")
    rules = url_rules.parse_rules(spark.createDataFrame([*RULES, RULES[0]], "action string, rule string"))
    parsed = [(a, r, r.partition("/")[0], "/" + r.partition("/")[2]) for a, r in RULES]
    got = url_rules.verdicts(df, rules).collect()
    assert len(got) == len(urls)
    for r in got:
        rest = (r.url or "").partition("://")[2]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fit = [(len(h), len(p), rule, a) for a, rule, h, p in parsed if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=(0, 0, None, "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best[2], best[3])
    assert url_rules.verdicts(df, rules.limit(0)).where("verdict <> 'allow'").count() == 0


def test_urls_with_columns_named_as_results(spark):
    rows = [(k, "http://b.com/de/", "h", "p", "r", "v", "w", "kept") for k in range(2)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, path string, rule string, verdict string, won string, own string")
    rules = url_rules.parse_rules(spark.createDataFrame(RULES, "action string, rule string"))
    for some, verdict in ((rules, ("com/de/", "block")), (rules.limit(0), (None, "allow"))):
        got = url_rules.verdicts(df, some).select("page_id", "own", "host", "path", "rule", "verdict").collect()
        assert sorted(tuple(r) for r in got) == [(k, "kept", "b.com", "/de/", *verdict) for k in range(2)]


def test_toxicity(spark, docs, odd, none):
    rng = random.Random(1)
    bad = ["scumbag", "morons"]
    rows = []
    for k in range(400):
        w = [f"w{rng.randrange(50)}" for _ in range(rng.randrange(5, 200))]
        if k % 5 == 0:
            w[rng.randrange(len(w))] = rng.choice(bad)
        rows.append((k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 0, int(k % 5 == 0)) for k in range(400)] + [(3, 0, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    model = nb_linear.fit(df, nb_linear.training_labels(labels))
    got = nb_linear.score(df, model).select("doc_id", nb_linear.held_out().alias("held"), "score").collect()
    held = [r for r in got if r.held]
    assert {r.doc_id for r in held} == {k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0}
    right = np.mean([(r.score >= 0.5) == (r.doc_id % 5 == 0) for r in held])
    assert right > 0.95
    assert all(0 <= r.score <= 1 for r in nb_linear.score(docs.union(odd), model).collect())
    assert nb_linear.score(none, nb_linear.fit(none, nb_linear.training_labels(labels.limit(0)))).count() == 0


def test_mix(docs, rows, odd, none):
    got = water_filling.mix(docs).collect()
    assert len(got) == len(rows)
    size, taken, target = {}, {}, {}
    for r in got:
        assert r.size == len(_words(rows[r.doc_id // 3][1])) and 0 <= r.taken <= 2 * r.size
        size[r.source] = size.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 1 and target[s] <= 2 * size[s] for s in size)
    want, left, total = {}, set(size), 1.5 * sum(size.values())
    weight = dict(zip(sorted(size, key=lambda s: (s is None, s or "")), [5, 2, 1] * 9))
    while True:
        level = (total - sum(want.values())) / sum(weight[s] for s in left)
        full = {s for s in left if weight[s] * level > 2 * size[s]}
        if not full:
            break
        want |= {s: 2 * size[s] for s in full}
        left -= full
    want |= {s: weight[s] * level for s in left}
    assert all(target[s] == pytest.approx(want[s]) for s in size)
    assert sorted(map(str, water_filling.mix(docs).collect())) == sorted(map(str, got))
    mixed = water_filling.mixed(docs, more=["lang"]).collect()
    assert sum(len(_words(r.text)) for r in mixed) == sum(taken.values())
    assert water_filling.mix(odd).count() == 14 and water_filling.mix(none).count() == 0


def _signs(text):
    w = [x for x in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower()) if x]
    stop = set(spotsigs.ANCHORS)
    at = [i for i, x in enumerate(w) if x in stop]
    content = [x for x in w if x not in stop]
    found = [(w[i], content[i - k], content[i - k + 1]) for k, i in enumerate(at) if i - k + 2 <= len(content)]
    return set(found or [tuple((w + [None, None])[i : i + 3]) for i in range(len(w))])


def test_fingerprints(docs, rows, odd, none):
    got = {r.doc_id: r for r in spotsigs.edited_fingerprints(docs).collect()}
    assert len(got) == len(rows)
    for k, row in enumerate(rows):
        text, follower = row[1] or "", rows[(k + 1) % len(rows)][1] or ""
        q = len(text) // 4
        edited, r = text[: len(text) - q] + follower[:q], got[row[0]]
        assert (r.n_chars, r.edited) == (len(text), edited)
        a, b, c = _signs(text), _signs(edited), _signs(follower)
        assert len(r.signs) == len(a) and r.signs == sorted(r.signs)
        like = lambda x, y: 1.0 if x == y else len(x & y) / len(x | y)
        assert r.near_edited == pytest.approx(like(a, b)) and r.near_next == pytest.approx(like(a, c))
    assert spotsigs.edited_fingerprints(odd).count() == 14 and spotsigs.edited_fingerprints(none).count() == 0


def _stretch_signs(text, stretch):
    w = [x for x in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower()) if x]
    stop = set(spotsigs.ANCHORS)
    found = set()
    for i, x in enumerate(w):
        chain = [y for y in w[i:] if y not in stop][:2]
        if x in stop and len(chain) == 2:
            found.add((x, *chain))
        if len({y in stop for y in w[i : i + stretch]}) == 1:
            found.add(tuple((w + [None, None])[i : i + 3]))
    return found


def test_fingerprints_of_the_query(spark, docs, rows):
    """Anchorless texts, texts with few anchors and texts of anchors alone keep their signatures when an anchor comes in."""
    bare = " ".join(f"cell{k} {k * k}" for k in range(100))
    dense = " ".join(f"the p{k} of q{k}" for k in range(100))
    sparse = "the " + " ".join(f"v{k}" for k in range(200)) + " of " + " ".join(f"u{k}" for k in range(200))
    texts = [bare, dense, sparse, dense + " x", "a " * 90, dense, "the", "", None, "日本 語 " * 3, *(r[1] for r in rows)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in spotsigs.edited_fingerprints(df, spotsigs.STRETCH).collect()}
    assert len(got) == len(texts)
    like = lambda x, y: 1.0 if x == y else len(x & y) / len(x | y)
    for k, text in enumerate(texts):
        text, follower = text or "", texts[(k + 1) % len(texts)] or ""
        q = len(text) // 4
        a, b, c = (_stretch_signs(t, spotsigs.STRETCH) for t in (text, text[: len(text) - q] + follower[:q], follower))
        r = got[k]
        assert len(r.signs) == len(a) and len(r.edited_signs) == len(b) and r.signs == sorted(r.signs)
        assert bool(a) == bool(_signs(text))
        assert r.near_edited == pytest.approx(like(a, b)) and r.near_next == pytest.approx(like(a, c))
    assert got[0].near_edited > 0.5 and got[2].near_edited > 0.5 and got[4].near_edited > 0
    assert len(got[2].signs) > 300
    assert like(_signs(bare), _signs(bare[: -len(bare) // 4] + dense[: len(bare) // 4])) == 0  # what the plain rule gives


def test_fingerprint_matches(docs, rows):
    signed = docs.select(F.col("doc_id").alias("rid"), spotsigs.signatures(F.col("text")).alias("signs")).cache()
    got = {(r.query, r.rid) for r in spotsigs.matches(signed.where("rid % 2 = 0"), signed, 0.6).collect()}
    sets = {r.rid: set(r.signs) for r in signed.collect()}
    want = {
        (a, b) for a in sets if a % 2 == 0 for b in sets
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])
    }
    assert got == want


def test_warc(spark, tmp_path):
    rng = random.Random(8)
    big = "".join(chr(rng.randrange(32, 900)) for _ in range(50_000))
    html = [None, "", "short", "short", "x" * 1000, "x" * 1000, "x" * 999, "x" * 999, big, big, "x" * 1000, "é" * 600]
    rows = [(k * 2, None if k == 3 else f"http://h/{k}\r\nX: y", h, "clash") for k, h in enumerate(html)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(2)
    folder = str(tmp_path / "warc")
    paths = warc_segments.write(pages, folder, segment=700, limit=20_000)
    got = {r.page_id: r for r in warc_segments.read(paths, folder).collect()}
    assert len(got) == len(rows)
    for page, _, text, _ in rows:
        data, r = (text or "").encode(), got[page]
        same = [p for p, _, t, _ in rows if (t or "") == (text or "") and len(data) >= 1000]
        last = max(same, default=page)
        assert r.complete and (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert (r.record_type, r.refers_to) == (("response", None) if last == page else ("revisit", last))
        assert r.payload == (data if last == page else None)
    lost = warc_segments.records(paths, folder).where("number is null or number <> 2")
    assert not all(r.complete for r in warc_segments.reassembled(lost).collect())


def test_warc_without_first_segments(spark, tmp_path, monkeypatch):
    rows = [(k, f"http://h/{k}", chr(97 + k) * size) for k, size in enumerate([100, 2000, 3000, 2000])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    folder = str(tmp_path / "warc")
    paths = warc_segments.write(pages, folder, segment=700)
    whole = warc_segments.records(paths, folder)
    lost = whole.where("number is null or number > 1 or page_id not in (1, 2)")
    got = {r.id: r for r in warc_segments.reassembled(lost).collect()}
    ids = {r.page_id: r.id for r in warc_segments.reassembled(whole).collect()}
    assert set(got) == set(ids.values())
    for page, name in ids.items():
        r = got[name]
        assert r.complete == (page in (0, 3)) and r.page_id == (page if r.complete else None)
        assert r.complete or (r.kind, r.url, r.digest, r.refers) == (None,) * 4
    monkeypatch.setattr(warc_segments, "records", lambda *_: lost)
    read = warc_segments.read(paths, folder).collect()
    assert len(read) == 4 and sum(r.complete for r in read) == 2
    assert all(r.payload is None and r.payload_bytes is None for r in read if not r.complete)


def test_warc_repeats(spark):
    rows = [(1, "u", "y" * 2000)] * 3 + [(None, None, None), (0, "u", "y" * 2000)]
    got = warc_segments.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(r.record_type for r in got) == ["response", "response", "revisit", "revisit", "revisit"]
    assert warc_segments.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_empty_tables(none):
    assert odd_sketches.near_duplicates(none).count() == 0
    assert token_files.tokenized(none, tokenizer_path()).count() == 0
    assert hilbert.shards(none).count() == 0
    assert recompression.remove_repeats(none).count() == 0


def test_pipeline(spark):
    """Each stage against a plain version of it on the same rows, except the classifier's own judgement."""
    import corpus_pipeline as pipeline
    from starweave.llm.common import keep, table

    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    for name, stage in pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = keep(stage(spark, docs, sf), name)
        after = docs.collect()
        if name == "near_dedup":
            want = {d for d, (_, _, kept) in _near(sorted(before.items()), 5).items() if kept}
            assert {r.doc_id for r in after} == want
        elif name != "tokens":
            assert {r.doc_id for r in after} <= set(before) and docs.columns == pipeline.COLUMNS
        if name in ("toxicity", "decontamination"):
            assert len(after) > 0.7 * len(before) and all(before[r.doc_id] == r.text for r in after)
        if name == "mixing":
            assert sum(len(_words(r.text)) for r in after) == pytest.approx(1.5 * sum(len(_words(t)) for t in before.values()), abs=30)
            number = len(after)
    assert len(after) == number and pipeline.ORACLE_SQL is None


def test_units_encoded_together_equal_whole_texts():
    tool = token_files.Encoder(tokenizer_path())
    parts = [" ", "  ", "\n", "\t", "\r\n", "\xa0", "\x85", "\x1c", "a", "'s", "don't", "!", "??", "é", "日本", "́"]
    parts += ["<|endoftext|>", "1", "_", "\0", "x" * 70, ",", "b."]
    draw = random.Random(1)
    texts = ["".join(draw.choices(parts, k=draw.randrange(25))) for _ in range(3000)]
    whole = [array("I", tool.tool.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]
    assert tool.encode(texts) == whole
    tool.gap = None  # a tokenizer without such a token
    tool.known.clear()
    assert tool.encode(texts) == whole


def test_plain_words_go_to_the_model():
    tool = token_files.Encoder(tokenizer_path())
    draw = random.Random(2)
    parts = [" "] * 6 + ["\n", ".\n", ",", "!", "a", "The", "straße", "À", "Œuvre", "\u0100b", "\u024f", "re", "x" * 70]
    texts = ["", " ", "a "] + ["".join(draw.choices(parts, k=draw.randrange(30))) for _ in range(3000)]
    whole = [array("I", tool.tool.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]
    assert tool.encode(texts) == whole
    for letter in map(chr, range(0x41, 0x250)):
        if token_files._SPELLED(letter):
            assert tool.encode([f"a b{letter}e{letter}.\n{letter}"]) == [array("I", tool.tool.encode(f"a b{letter}e{letter}.\n{letter}").ids).tobytes()]
    seen = []
    tool.known.clear()
    tool._behind_space = lambda units: seen.extend(units) or [b""] * len(units)
    plain = "a Word, or two.\nÉlan vital! Straße"
    assert tool.encode([plain]) == [array("I", tool.tool.encode(plain, add_special_tokens=False).ids).tobytes()] and seen == []


def _clean(texts, items):
    """Which texts the benchmark windows cover by less than a twentieth of their words."""
    phrases = {}
    for item in items:
        t = _terms(item)
        n = min(13, len(t))
        for k in range(len(t) - n + 1 if t else 0):
            phrases.setdefault(n, set()).add(tuple(t[k : k + n]))
    clean = set()
    for doc, text in texts.items():
        w, hit = _terms(text), set()
        for n, known in phrases.items():
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in known:
                    hit.update(range(i, i + n))
        if not hit or 20 * len(hit) < len(w):
            clean.add(doc)
    return clean


def _mixed(rows):
    """(doc_id, text, source) of the mix of ``rows`` alike, ids being unique."""
    size = {}
    for _, text, source in rows:
        size[source] = size.get(source, 0) + len(_words(text))
    weight = dict(zip(sorted(size, key=lambda s: (s is None, s or "")), [5, 2, 1] * len(size)))
    target, left, total = {}, set(size), 1.5 * sum(size.values())
    while left:
        level = (total - sum(target.values())) / sum(weight[s] for s in left)
        full = {s for s in left if weight[s] * level > 2 * size[s]}
        if not full:
            target |= {s: weight[s] * level for s in left}
            break
        target |= {s: 2 * size[s] for s in full}
        left -= full
    out = []
    for source, n in size.items():
        whole = int(target[source] // n) if n else 0
        rest = int(target[source] + 0.5) - whole * n if n else 0
        own = [r for r in rows if r[2] == source]
        for doc, text, _ in sorted(own, key=lambda r: (hashlib.md5(f"mix|{r[0]}".encode()).hexdigest(), r[0])):
            words = (text or "").encode().split()
            part = max(0, min(len(words), rest))
            rest -= part
            if words:
                out += [(doc, text, source)] * (whole + (part == len(words)))
            if 0 < part < len(words):
                out.append((doc, b" ".join(words[:part]).decode(), source))
    return out


def test_pipeline_rows(spark):
    """The ids after decontamination, the rows of the mix and the tokens of each row against plain versions on the same rows."""
    from tokenizers import Tokenizer

    import corpus_pipeline as pipeline
    from starweave.llm.common import keep, table

    sf, tool = "/root/testdata/sf0.001", Tokenizer.from_file(tokenizer_path())
    docs, items = table(spark, sf, "documents"), [r.text for r in table(spark, sf, "benchmark").collect()]
    found = {}
    for name, stage in pipeline.STAGES:
        before = docs.collect()
        docs = keep(stage(spark, docs, sf), name)
        found[name] = (before, docs.collect())
    before, after = found["decontamination"]
    want = _clean({r.doc_id: r.text for r in before}, items)
    assert sorted(r.doc_id for r in after) == sorted(want) and len(want) < len(before)
    before, after = found["mixing"]
    key = lambda r: tuple(map(str, r))
    got = [(r.doc_id, r.text, r.source) for r in after]
    assert sorted(got, key=key) == sorted(_mixed([(r.doc_id, r.text, r.source) for r in before]), key=key)
    assert all(r.n_chars == len(r.text) for r in after)
    before, after = found["tokens"]
    ids = [(r.doc_id, np.array([*tool.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")) for r in before]
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in after) == sorted((d, len(x), zlib.crc32(x.tobytes())) for d, x in ids)
    start, placed = 0, sorted(after, key=lambda r: r.start)
    for r in placed:
        assert r.start == start
        start += r.n_tokens
    assert [r.doc_id for r in placed] == sorted(r.doc_id for r in before)


@pytest.mark.parametrize("run", ["near_duplicates", "score"])
def test_batches_of_texts_are_bounded(spark, run):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    few = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    if run == "score":
        nb_linear.score(few, nb_linear.Model(np.zeros(nb_linear._BINS, np.float32), 0.0)).collect()
    else:
        odd_sketches.near_duplicates(few).collect()

    def told(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes]})

    texts = spark.range(0, 200, 1, 1).select(F.repeat(F.lit("x"), 200_000).alias("text"))
    assert max(r[0] for r in texts.mapInArrow(told, "bytes long").collect()) < 5_000_000
    spark.conf.set(name, "1m")
    small_batches(spark)
    assert spark.conf.get(name) == "1m"  # a smaller one stays
    spark.conf.unset(name)
