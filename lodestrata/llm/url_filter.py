"""Operator 1: URL filter with pattern rules indexed by their rarest literal token.

A rule is a regular expression with the literal tokens (runs of letters and digits)
that every URL it fits must hold. The tokens' counts over all URLs are taken first,
and each rule is filed under its rarest one; a rule without tokens is filed under
the empty token, which every URL has. Distinct URLs are cut into tokens, tokens
fetch candidate rules, and only those run their expressions.

Host and path: see `host_of` and `path_of`. The rule `host/path` fits that host
and its subdomains if the path starts with the rule's. Of the host rules that fit the
longest decides; ties go to block, then to the smaller rule. Without one, a URL
that fits a pattern rule gets that rule's verdict (block before allow), else `allow`.

Null URLs and URLs without `://` have an empty host and path, fit no host rule and
are allowed. Repeated URLs are judged once and get equal rows. Rows of an empty
table: none. Only DataFrame functions run; the index is broadcast while it has at
most BROADCAST_RULES rules, beyond that the join is left to the optimizer.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_RULES = 50_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(.*)$"
_NO_TOKEN = r"[^a-z0-9\x{80}-\x{10FFFF}]+"

# The host rules of the contract.
HOST_RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]

# Words that mark a URL as unwanted wherever they stand as a token.
BLOCKED_WORDS = ["adserver", "casino", "doubleclick", "phishing", "porn", "viagra", "xxx"]


@dataclass(frozen=True)
class Rule:
    """`pattern` is matched against host, path, query and fragment together."""

    text: str
    action: str
    pattern: str
    tokens: tuple[str, ...]
    by_host: bool


def _escaped(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9\u0080-\U0010ffff])", r"\\\1", text)


def _tokens(text: str) -> list[str]:
    return [t for t in re.split(r"[^a-z0-9\u0080-\U0010ffff]+", text) if t]


def host_rule(action: str, text: str) -> Rule:
    host, slash, rest = text.partition("/")
    host = host.translate(str.maketrans(_UPPER, _LOWER))
    path = slash + rest
    lead = r"^(?:[^/?#]*\.)?" if host else "^[^/?#]*"
    low = path.translate(str.maketrans(_UPPER, _LOWER))
    # the last token of a path may go on in the URL; only what ends inside is whole
    whole = _tokens(re.sub(r"[a-z0-9\u0080-\U0010ffff]+$", "", low))
    return Rule(text, action, lead + _escaped(host + path), (*_tokens(host), *whole), True)


def word_rule(action: str, word: str) -> Rule:
    edge = r"[^A-Za-z0-9\x{80}-\x{10FFFF}]"
    pattern = rf"(?i)(?:^|{edge}){_escaped(word)}(?:{edge}|$)"
    return Rule(word, action, pattern, (word,), False)


def default_rules() -> list[Rule]:
    return [host_rule(*r) for r in HOST_RULES] + [word_rule("block", w) for w in BLOCKED_WORDS]


def _part(url: Column, number: int) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, number), F.lit(""))


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased."""
    return F.translate(_part(url, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return _part(url, 2)


def _table(spark: SparkSession, rows: list[Column]) -> DataFrame:
    return spark.range(1).select(F.inline(F.array(*rows)))


def rule_index(tokens: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rules with the token they are filed under; `tokens` has a row a URL and token."""
    spark = tokens.sparkSession
    rows = [
        F.struct(
            F.lit(i).alias("rule_no"),
            F.lit(r.text).alias("rule"),
            F.lit(r.action).alias("action"),
            F.lit(r.pattern).alias("pattern"),
            F.lit(r.by_host).alias("by_host"),
            F.array(*[F.lit(t) for t in r.tokens or ("",)]).alias("own"),
        )
        for i, r in enumerate(rules)
    ]
    filed = _table(spark, rows).withColumn("token", F.explode("own")).drop("own")
    wanted = filed.select("token").distinct()
    counts = (
        tokens.join(F.broadcast(wanted) if len(rules) <= BROADCAST_RULES else wanted, "token")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rarest = (
        filed.join(counts, "token", "left")
        .groupBy("rule_no", "rule", "action", "pattern", "by_host")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("least"))
    )
    return rarest.select("rule", "action", "pattern", "by_host", F.col("least.token").alias("token"))


def filter_urls(pages: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, word (the pattern rule that fits), per row."""
    rules = default_rules() if rules is None else rules
    urls = pages.select(F.col("url").alias("_url")).where("_url IS NOT NULL").distinct()
    subject = F.concat(host_of(F.col("_url")), _part(F.col("_url"), 2), _part(F.col("_url"), 3))
    low = F.translate(subject, _UPPER, _LOWER)
    tokens = (
        urls.where(F.instr("_url", "://") > 0)
        .withColumn("_subject", subject)
        .withColumn("token", F.explode(F.array_distinct(
            F.concat(F.split(low, _NO_TOKEN), F.array(F.lit("")))
        )))
    )
    head = pages.select("page_id", F.col("url").alias("_url"))
    if rules:
        index = rule_index(tokens.select("token"), rules)
        index = F.broadcast(index) if len(rules) <= BROADCAST_RULES else index
        fits = tokens.join(index, "token").where(F.expr("_subject RLIKE pattern"))
        rank = F.struct(
            (-F.length("rule")).alias("shorter"),
            (F.col("action") != "block").alias("allows"),
            F.col("rule").alias("rule"),
        )
        word = F.struct((F.col("action") != "block").alias("allows"), F.col("rule").alias("rule"))
        best = fits.groupBy("_url").agg(
            F.min(F.when(F.col("by_host"), rank)).alias("_top"),
            F.min(F.when(~F.col("by_host"), word)).alias("_word"),
        )
        judged = head.join(best, "_url", "left")
    else:
        judged = head.withColumns(
            {
                "_top": F.lit(None).cast("struct<allows:boolean,rule:string>"),
                "_word": F.lit(None).cast("struct<allows:boolean,rule:string>"),
            }
        )
    allows = F.coalesce("_top.allows", "_word.allows", F.lit(True))
    return judged.select(
        "page_id",
        host_of(F.col("_url")).alias("host"),
        path_of(F.col("_url")).alias("path"),
        F.col("_top.rule").alias("rule"),
        F.when(allows, "allow").otherwise("block").alias("verdict"),
        F.col("_word.rule").alias("word"),
    )


def keep_allowed(pages: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """The pages whose URL is allowed, all columns as they are."""
    judged = filter_urls(pages.select(F.col("url").alias("page_id"), "url"), rules)
    bad = judged.where("verdict = 'block'").select(F.col("page_id").alias("_bad")).distinct()
    return pages.join(bad, pages["url"] == bad["_bad"], "left_anti")


#: The same rows in DuckDB: every rule against every URL.
ORACLE_SQL = """
WITH parts AS (
  SELECT page_id, url,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(.*)$', 1), '') AS raw,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(.*)$', 2), '') AS path,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(.*)$', 3), '') AS rest
  FROM pages
), named AS (
  SELECT *, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
  FROM parts
), tried AS (
  SELECT *, '.' || host AS dotted,
    CASE
      WHEN dotted LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN dotted LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN dotted LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN dotted LIKE '%.net' AND starts_with(path, '/') THEN 'net/'
    END AS rule,
    CASE WHEN contains(coalesce(url, ''), '://') THEN nullif(regexp_extract(
      lower(host || path || rest),
      '(?:^|[^a-z0-9])(adserver|casino|doubleclick|phishing|porn|viagra|xxx)(?:[^a-z0-9]|$)', 1
    ), '') END AS word
  FROM named
)
SELECT page_id, host, path, rule, word,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
       WHEN rule IS NULL AND word IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM tried
"""
