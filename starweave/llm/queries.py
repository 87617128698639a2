"""The registered query of each operator, and its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    block_names,
    hilbert,
    nb_linear,
    odd_sketches,
    positional_index,
    recompression,
    spelling,
    spotsigs,
    token_files,
    url_rules,
    warc_segments,
    water_filling,
)
from .common import WORD, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(sql: str | None = None):
    def put(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return put


@register(
    rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) = 1 THEN ws[1] ELSE ws[i] || ' ' || ws[i + 1] END AS g
 FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws), 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(id, top) AS (SELECT doc_id, doc_id FROM documents UNION SELECT b, top FROM reach JOIN both_ways ON a = id),
c AS (SELECT id, min(top) AS component_id FROM reach GROUP BY id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN c ON id = doc_id LEFT JOIN n USING (doc_id)""".replace("WITH w", "WITH RECURSIVE w")
)
def op1_odd_sketches(spark, sf):
    found = odd_sketches.near_duplicates(table(spark, sf, "documents"), shingle=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@register(
    rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS i, ws FROM w),
keyed AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS k FROM win),
firsts AS (SELECT k, min(doc_id::HUGEINT * 1000000000 + i) AS f FROM keyed GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM keyed JOIN firsts USING (k) WHERE doc_id::HUGEINT * 1000000000 + i > f),
lost AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
 sha256(CASE WHEN ps IS NULL THEN array_to_string(ws, ' ')
  ELSE array_to_string(list_filter(ws, lambda x, j: NOT list_contains(ps, j)), ' ') END) AS kept_sha256
FROM w LEFT JOIN lost USING (doc_id)"""
)
def op4_recompression(spark, sf):
    return recompression.remove_repeats(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "n_removed", F.coalesce(F.sha2("kept", 256), "whole_sha256").alias("kept_sha256")
    )


_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@register(
    f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS ws FROM documents),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER}, '{_TERM}') AS ws FROM benchmark),
p AS (SELECT item, array_to_string(ws[i:i + 12], ' ') AS k, len(ws[i:i + 12]) AS n FROM
 (SELECT item, ws, unnest(range(1, greatest(len(ws) - 11, 2))) AS i FROM b WHERE len(ws) > 0)),
lengths AS (SELECT DISTINCT n FROM p),
hit AS (SELECT DISTINCT doc_id, i, n, item FROM
 (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS k FROM
  (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, lengths WHERE len(ws) >= n)) JOIN p USING (k, n)),
covered AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS w FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
 sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""
)
def op5_positional_index(spark, sf):
    found = positional_index.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


@register(
    """
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
h AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
 regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(action, rh, rp) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
 ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
m AS (SELECT page_id, host, path, rh || rp AS rule, action, row_number() OVER (PARTITION BY page_id ORDER BY length(rh) DESC NULLS LAST, length(rp) DESC) AS k
 FROM h LEFT JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM m WHERE k = 1"""
)
def op6_url_rules(spark, sf):
    rules = url_rules.parse_rules(spark.createDataFrame(RULES, "action string, rule string"))
    found = url_rules.verdicts(table(spark, sf, "pages").select("page_id", "url"), rules)
    return found.select("page_id", "host", "path", "rule", "verdict")


@register(
    rf"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
 md5('mix|' || doc_id) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n, [5, 2, 1][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)] AS w FROM d GROUP BY source),
total AS (SELECT sum(n)::BIGINT AS t FROM s),
fill(k, stopped, level) AS (
 SELECT 0, -1::BIGINT, 0::DOUBLE
 UNION ALL
 SELECT k + 1, c, (1.5::DOUBLE * t - taken) / weight FROM
  (SELECT k, stopped, t, count(*) FILTER (w * level > 2 * n) AS c,
    coalesce(sum(2 * n) FILTER (w * level > 2 * n), 0)::DOUBLE AS taken, (sum(w) FILTER (w * level <= 2 * n))::DOUBLE AS weight
   FROM fill, s, total GROUP BY k, stopped, t, level) WHERE c > stopped AND weight > 0),
lv AS (SELECT level FROM fill ORDER BY k DESC LIMIT 1),
g AS (SELECT source, n, CASE WHEN w * level > 2 * n THEN (2 * n)::DOUBLE ELSE w * level END AS target FROM s, lv),
r AS (SELECT source, n, target, coalesce(floor(target / n)::BIGINT, 0) AS whole FROM g),
o AS (SELECT doc_id, size, n, target, whole, round(target)::BIGINT - whole * n AS rest,
 coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
 FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, n AS source_size, target, (whole * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM o"""
)
def op8_water_filling(spark, sf):
    found = water_filling.mix(table(spark, sf, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


@register()
def op9_spotsigs(spark, sf):
    found = spotsigs.edited_fingerprints(table(spark, sf, "documents"), spotsigs.STRETCH)
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        spotsigs.spelled(F.col("signs")).alias("fingerprint"),
        spotsigs.spelled(F.col("edited_signs")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


#: The vocabulary files, in the place where the environment keeps public tokenizers.
TOKENIZER, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(PIECES)


@register()
def op2_token_files(spark, sf):
    return token_files.tokenized(table(spark, sf, "documents"), tokenizer_path())


@register()
def op3_hilbert(spark, sf):
    return hilbert.shards(table(spark, sf, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@register()
def op7_nb_linear(spark, sf):
    docs = table(spark, sf, "documents")
    model = nb_linear.fit(docs, nb_linear.training_labels(table(spark, sf, "labels")))
    return nb_linear.score(docs, model).select(
        "doc_id",
        nb_linear.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@register(
    """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha1(h) AS payload_digest, max(page_id) OVER (PARTITION BY sha1(h)) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
 CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
 CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to FROM d"""
)
def op10_warc_segments(spark, sf):
    return warc_segments.round_trip(table(spark, sf, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@register(
    """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x)::BIGINT AS group_size,
 doc_id = max(doc_id) OVER (PARTITION BY x) AS kept, sha256(x) AS text_sha256 FROM t"""
)
def op12_block_names(spark, sf):
    return block_names.deduplicated(table(spark, sf, "documents")).drop("rid")


def _crc32(text: str) -> str:
    """SQL for the CRC-32 of a string of code points below 2048, in UTF-8."""
    step = "CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    bits = f"list_reduce(list_prepend(xor(c, b), [0::BIGINT, 1, 2, 3, 4, 5, 6, 7]), lambda a, i: {step})"
    codes = f"list_transform(string_split({text}, ''), lambda ch: ord(ch)::BIGINT)"
    data = f"flatten(list_transform({codes}, lambda o: CASE WHEN o < 128 THEN [o] ELSE [192 + (o >> 6), 128 + (o & 63)] END))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data}), lambda c, b: {bits}), 4294967295)"


#: Letters of two bytes, and a letter of one byte for each: DuckDB counts edits by bytes.
_WIDE = "".join(map(chr, range(0xC0, 0x100)))
_NARROW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!#$%&()*+,-./:;<=>?@[]^_{|}~"


@register(
    rf"""
WITH RECURSIVE r AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z{_WIDE[0]}-{_WIDE[-1]}]+')) AS run FROM documents),
c AS (SELECT doc_id, run, count(*) AS k FROM r WHERE length(run) >= 5 GROUP BY ALL),
h AS (SELECT run, k, {_crc32("doc_id || ':' || run")} AS h FROM c),
w AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM h),
v AS MATERIALIZED (SELECT word, sum(k)::BIGINT AS n, translate(word, '{_WIDE}', '{_NARROW}') AS t FROM w WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
near AS MATERIALIZED (SELECT a.word, b.word AS near, a.n, b.n AS m FROM v a JOIN v b ON length(b.t) BETWEEN length(a.t) - 1 AND length(a.t) + 1 AND a.t <> b.t AND levenshtein(a.t, b.t) = 1),
f AS MATERIALIZED (SELECT word, near AS form, m AS form_n FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY m DESC, near) AS place FROM near) WHERE place = 1 AND m >= 2 * n),
walk(word, here, steps) AS (SELECT word, word, 0 FROM v UNION ALL SELECT walk.word, form, steps + 1 FROM walk JOIN f ON f.word = walk.here),
last AS (SELECT word, max_by(here, steps) AS root FROM walk GROUP BY word),
many AS (SELECT word, count(*) AS n_near FROM near GROUP BY word)
SELECT word, form, root, n, coalesce(n_near, 0)::BIGINT AS n_near, form_n
FROM v JOIN last USING (word) LEFT JOIN f USING (word) LEFT JOIN many USING (word)"""
)
def op11_spelling(spark, sf):
    return spelling.variants(spelling.vocabulary(table(spark, sf, "documents")))


@register()
def op13_alignment(spark, sf):
    return alignment.aligned(table(spark, sf, "documents"), tokenizer_path(), piece_path())
