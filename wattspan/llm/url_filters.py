"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a regular expression with the whole tokens (runs of a-z and 0-9) that
any matching URL must contain. Token frequencies over the table's URLs choose
each rule's rarest token; the URL's own tokens fetch its candidate rules by a
join, and only these expressions run. Rules without a token run on every URL.

Site rules (host and path prefix) win by length over each other, and over
pattern rules; without either a URL is allowed. A null URL, or one without
``://``, has an empty host and path; it matches no site rule. Repeated rows get
equal verdicts: judging works on distinct URLs, so a hot URL is judged once.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from wattspan.functions.columns import qcol
from wattspan.llm.frames import broadcast_if_small

# Site rules as (verdict, host and path).
SITE_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
# Pattern rules on the lower-cased URL: verdict, expression, tokens that every match contains whole.
PATTERN_RULES = [
    ("block", r"://(?:[^/?#]*[.-])?casino[.-]", ["casino"]),
    ("block", r"://(?:[^/?#]*[.-])?bets[.-]", ["bets"]),
    ("block", r"://(?:[^/?#]*[.-])?cheap-pills\.", ["cheap", "pills"]),
    ("block", r"[/.]login(?:[/?#.]|$)", ["login"]),
    ("block", r"[?&]session=[0-9a-f]+", ["session"]),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULE_BYTES = 512


def site_rule(text: str) -> tuple[str, list[str]]:
    """Expression on host and path, and whole tokens, of a rule such as ``example.org/es/``."""
    host, slash, path = text.partition("/")
    whole = re.findall(r"[a-z0-9]+", host.lower()) + [
        # The last token of a prefix may go on, unless something ends it.
        m[0] for m in re.finditer(r"[a-z0-9]+", (slash + path).lower()) if m.end() < len(slash + path)
    ]
    # Spark's and Java's quoting agree with this one on letters, digits, dots and slashes.
    literal = "".join(c if c.isalnum() or c == "/" else "\\" + c for c in host + slash + path)
    return rf"^(?:[^/]*\.)?{literal}", whole


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def tokens(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(ascii_lower(c), F.lit("[a-z0-9]+"), 0))


def rule_index(spark, urls: DataFrame, site_rules=None, pattern_rules=None) -> tuple[DataFrame, int]:
    """Rules with the literal token that is rarest in ``urls``, ties by the token, null without one; and their number."""
    rows = []
    for verdict, text in SITE_RULES if site_rules is None else site_rules:
        pattern, whole = site_rule(text)
        rows.append((len(rows), verdict, text, pattern, whole))
    for verdict, pattern, whole in PATTERN_RULES if pattern_rules is None else pattern_rules:
        rows.append((len(rows), verdict, None, pattern, whole))
    rules = spark.createDataFrame(rows, "no int, action string, site string, pattern string, whole array<string>")
    literals = rules.select("no", F.explode("whole").alias("token"))
    wanted = broadcast_if_small(literals.select("token").distinct(), 4 * len(rows), RULE_BYTES)
    counts = urls.select(F.explode("tokens").alias("token")).join(wanted, "token").groupBy("token").agg(
        F.count(F.lit(1)).alias("n"))
    rarest = literals.join(counts, "token", "left").groupBy("no").agg(
        F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), F.col("token"))).alias("token"))
    return rules.join(rarest, "no", "left").drop("whole"), len(rows)


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", site_rules=None, pattern_rules=None
               ) -> DataFrame:
    """Per row: the id, ``host``, ``path``, ``rule`` (the winning site rule) and ``verdict``."""
    slim = pages.select(qcol(id_col).alias("_id"), qcol(url_col).cast("string").alias("_url"))
    url = F.coalesce("_url", F.lit(""))
    host = ascii_lower(F.regexp_extract(url, "://([^/?#]*)", 1))
    path = F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1)
    distinct = slim.select("_url").filter("_url IS NOT NULL").distinct().withColumn("tokens", tokens(F.col("_url")))
    index, many = rule_index(pages.sparkSession, distinct, site_rules, pattern_rules)
    candidates = distinct.select("_url", F.explode("tokens").alias("token")).join(
        broadcast_if_small(index, many, RULE_BYTES), "token")
    whole = [w for _, _, w in (PATTERN_RULES if pattern_rules is None else pattern_rules)]
    whole += [site_rule(t)[1] for _, t in (SITE_RULES if site_rules is None else site_rules)]
    if not all(whole):
        bare = broadcast_if_small(index.filter("token IS NULL"), many, RULE_BYTES)
        candidates = candidates.unionByName(distinct.select("_url").crossJoin(bare))
    subject = F.when(F.col("site").isNull(), ascii_lower(F.col("_url"))).otherwise(F.concat(host, path))
    hits = candidates.filter(F.rlike(subject, F.col("pattern")))
    best = F.max(F.when(F.col("site").isNotNull(), F.struct(F.length("site").alias("n"), "site", "action")))
    found = hits.groupBy("_url").agg(
        best.alias("best"), F.max(F.when(F.col("site").isNull(), F.col("action"))).alias("other"))
    out = slim.join(found, "_url", "left")
    return out.select(
        F.col("_id").alias(id_col), host.alias("host"), path.alias("path"), F.col("best.site").alias("rule"),
        F.coalesce("best.action", "other", F.lit("allow")).alias("verdict"))
