"""URL filters: host-suffix and path-prefix expressions matched by hash prefix.

A rule is a host and a path. It fits that host and its subdomains, if the url's path starts with the
rule's. Every distinct url is expanded into the expressions that rules of the given shapes could
spell: the last l labels of its host and the first q characters of its path, for each (l, q) among the
rules. Expressions meet rules in an equi-join on the first 32 bits of their SHA-256; the full
digest then confirms. The longest host wins, then the longest path, then block over allow.

Defined results: a url that is null or has no ``://`` has an empty host and path and no rule.
The same rule given twice counts once. Extra columns stay; one that is named as a result, or ``won``, gives way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, lower_ascii

#: What an url gets that no rule fits.
DEFAULT = "allow"
PREFIX_HEX = 8


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def parse_rules(rules: DataFrame) -> DataFrame:
    """(action, rule) with rules spelled ``host/path`` to action, rule, host and path."""
    cut = F.instr("rule", "/")
    return rules.select(
        "action",
        "rule",
        F.when(cut > 0, F.substr("rule", F.lit(1), cut - 1)).otherwise(F.col("rule")).alias("host"),
        F.when(cut > 0, F.substr("rule", cut)).otherwise("").alias("path"),
    )


def verdicts(urls: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``urls`` (with a column url) and host, path, rule, verdict; ``rules`` as from ``parse_rules``."""
    rules = rules.select("action", "rule", F.lower("host").alias("rule_host"), F.col("path").alias("rule_path"))
    shape = rules.select(F.size(F.split("rule_host", r"\.")).alias("labels"), F.char_length("rule_path").alias("chars"))
    # one row per distinct shape: label counts and path lengths, not rules
    shapes = [(r.labels, r.chars) for r in shape.distinct().collect()]
    digest = F.sha2(F.concat("rule_host", "rule_path"), 256)
    signed = rules.distinct().withColumn("digest", digest)
    signed = signed.withColumn("prefix", F.left("digest", F.lit(PREFIX_HEX)))

    urls = urls.drop("host", "path", "rule", "verdict", "won")
    parts = urls.select("url").where("url is not null").distinct()
    parts = parts.select("url", host_of(F.col("url")).alias("h"), path_of(F.col("url")).alias("p"))
    labels, chars = F.split("h", r"\."), F.char_length("p")
    asked = F.array(*(F.struct(F.lit(a).alias("l"), F.lit(b).alias("q")) for a, b in shapes)) if shapes else None
    matched = None
    if asked is not None:
        fits = F.filter(asked, lambda s: (s["l"] <= F.size(labels)) & (s["q"] <= chars))
        suffix = lambda s: F.call_function("substring_index", F.col("h"), F.lit("."), -s["l"])
        spell = F.transform(fits, lambda s: F.sha2(F.concat(suffix(s), F.left("p", s["q"])), 256))
        spread = parts.select("url", F.explode(spell).alias("own"))
        spread = spread.withColumn("prefix", F.left("own", F.lit(PREFIX_HEX)))
        order = F.struct(F.char_length("rule_host"), F.char_length("rule_path"), F.col("action") == "block", "rule")
        matched = (
            spread.join(signed, "prefix")
            .where("own = digest")
            .groupBy("url")
            .agg(F.max_by(F.struct("rule", "action"), order).alias("won"))
        )
    judged = urls.join(matched, "url", "left") if matched is not None else urls.withColumn("won", F.lit(None))
    return judged.select(
        *(F.col(c) for c in urls.columns),
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        *(
            (F.col("won.rule").alias("rule"), F.coalesce("won.action", F.lit(default)).alias("verdict"))
            if matched is not None
            else (F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
        ),
    )
