"""URL filter: rules on host and path, and a list of URLs behind a blocked Bloom filter.

A rule names a host and the beginning of a path; it fits that host and all its subdomains,
and the longest fitting rule decides.  A URL that no rule fits is looked up in the
list by its canonical form.  The list is first condensed to a Bloom filter of
256-bit blocks: one hash chooses the block, another sets one bit in each of its four
64-bit words.  URLs whose bits are all set go on to a hash join with the list itself,
which removes the false positives; all others are decided without a shuffle.

Few rules are expressions on each row.  More of them are a table: the label suffixes of
each distinct host meet the hosts of rules, which tell how long their paths are, and the
beginnings of the page's path of these lengths meet the rules themselves.

The filter (see ``bloom``) has never more than a fixed number of blocks, about 12 MB, so it may be broadcast whatever the length of the list; on a longer list more
URLs take the exact join.  Everything runs in the JVM.

Canonical form: host without a leading ``www.`` and a default port, path without slashes
at its end, and the query's parameters in order without those that only track.
Scheme and fragment do not count.

Defined cases: a NULL URL, or one without ``://``, has empty host and path, fits no rule, is
not listed and allowed; repeated rows and NULL ids are judged like others; an empty
table gives an empty result; further columns are kept out, whatever their names.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from credmill.llm import bloom

# Rules that are written as expressions; more are joined.
INLINE_RULES = 200
# From the first :// on: host up to a slash, question mark or hash sign; then the path.
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)\??([^#]*)"
# Parameters that say where a visitor came from.
TRACKING = r"^(utm_.*|ref|fbclid|gclid)(=|$)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)
# Hosts of the query's list have this label.
LISTED_LABEL = "spam-farm"


def with_parts(pages: DataFrame) -> DataFrame:
    """Host, path and canonical form of each URL."""
    host = F.translate(F.regexp_extract("url", PARTS, 1), string.ascii_uppercase, string.ascii_lowercase)
    kept = F.filter(F.split(F.regexp_extract("url", PARTS, 3), "&"), lambda p: ~p.rlike(TRACKING) & (p != ""))
    parts = pages.select(
        "page_id",
        F.coalesce(host, F.lit("")).alias("host"),
        F.coalesce(F.regexp_extract("url", PARTS, 2), F.lit("")).alias("path"),
        F.coalesce(F.array_join(F.array_sort(kept), "&"), F.lit("")).alias("parameters"),
    )
    plain_host = F.regexp_replace("host", r"^www\.|:(80|443)$", "")
    plain_path = F.regexp_replace("path", "/+$", "")
    canonical = F.concat(
        plain_host, plain_path, F.when(F.col("parameters") != "", F.concat(F.lit("?"), "parameters")).otherwise("")
    )
    return parts.select("page_id", "host", "path", F.when(F.col("host") != "", canonical).alias("canonical"))


def longest_rule(rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; NULL if none does.

    Of rules of equal length the one with the longer host decides, then the first in
    alphabetical order; of a rule with both verdicts, block.
    """
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host), [-ord(c) for c in r.text], r.verdict)):
        in_host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        fits = in_host & F.col("path").startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def with_joined_rules(parts: DataFrame, rules: DataFrame) -> DataFrame:
    """Text and verdict of the longest rule that fits each row, as ``longest_rule`` does it."""
    rules = rules.select("verdict", F.col("host").alias("rule_host"), F.col("path").alias("rule_path")).dropna()
    lengths = rules.groupBy("rule_host").agg(F.collect_set(F.length("rule_path")).alias("lengths"))
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hosts = parts.select("host").distinct().withColumn("rule_host", F.explode(suffix)).join(lengths, "rule_host")
    urls = parts.select("host", "path").distinct()
    fitting = F.filter("lengths", lambda n: n <= F.length("path"))
    asked = urls.join(hosts, "host").select("host", "path", "rule_host", F.explode(fitting).alias("n"))
    asked = asked.withColumn("rule_path", F.col("path").substr(F.lit(1), F.col("n")))
    text = F.concat("rule_host", "rule_path")
    # The least is the longest rule, then that of the longer host, the first one, and block.
    order = F.struct(
        (-F.length(text)).alias("size"), (-F.length("rule_host")).alias("host_size"), text.alias("rule"),
        (F.col("verdict") != "block").alias("allows"), "verdict",
    )
    best = asked.join(rules, ["rule_host", "rule_path"]).groupBy("host", "path").agg(F.min(order).alias("best"))
    return parts.join(best, ["host", "path"], "left").select(parts.columns + ["best.rule", "best.verdict"])


def judge(pages: DataFrame, listed: DataFrame, *, rules: tuple[Rule, ...] | DataFrame = RULES) -> DataFrame:
    """Verdict on each row of ``pages``; ``listed`` has a column ``canonical``.

    ``rules`` are given one by one, or as a table with verdict, host and path.
    """
    listed = listed.select("canonical").filter("canonical IS NOT NULL").distinct()
    blocks = bloom.blocks_for(listed.count())
    parts = with_parts(pages)
    if isinstance(rules, tuple) and len(rules) > INLINE_RULES:
        rows = [(rule.verdict, rule.host, rule.path) for rule in rules]
        rules = pages.sparkSession.createDataFrame(rows, "verdict string, host string, path string")
    if isinstance(rules, tuple):
        rule, verdict = longest_rule(rules)
        ruled = parts.select("*", rule.alias("rule"), verdict.alias("verdict"))
    else:
        ruled = with_joined_rules(parts, rules)
    asked = ruled.withColumn("block", F.when(F.col("rule").isNull(), bloom.block_of("canonical", blocks)))
    found = asked.join(F.broadcast(bloom.condensed(listed, "canonical", blocks)), "block", "left")
    found = found.withColumn("possible", bloom.all_set("canonical"))
    columns = ("page_id", "host", "path", "rule")
    decided = found.filter(~F.col("possible")).select(
        *columns, F.coalesce("verdict", F.lit("allow")).alias("verdict")
    )
    exact = listed.withColumn("listed", F.lit("block"))
    looked_up = (
        found.filter("possible")
        .join(exact.hint("shuffle_hash"), "canonical", "left")
        .select(*columns, F.coalesce("listed", F.lit("allow")).alias("verdict"))
    )
    return decided.unionByName(looked_up)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: verdict on every page; listed are the pages of hosts with a certain label."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    label = F.array_contains(F.split("host", r"\."), LISTED_LABEL)
    return judge(pages, with_parts(pages).filter(label).select("canonical"))


ORACLE_SQL = r"""
WITH cut AS (
  SELECT page_id, url,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    string_split(regexp_extract(url, '(?s)^.*?://[^/?#]*[^?#]*\?([^#]*)', 1), '&') AS params
  FROM pages
), named AS (
  SELECT page_id, host, path,
    CASE WHEN host <> '' THEN
      regexp_replace(host, '^www\.|:(80|443)$', '', 'g') || regexp_replace(path, '/+$', '') ||
      coalesce('?' || nullif(array_to_string(list_sort(list_filter(params,
        lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_.*|ref|fbclid|gclid)(=|$)'))), '&'), ''), '')
    END AS canonical
  FROM cut
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/'
  END AS rule FROM named
), listed AS (
  SELECT DISTINCT canonical FROM named WHERE list_contains(string_split(host, '.'), 'spam-farm')
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
       WHEN rule IS NOT NULL THEN 'block'
       WHEN canonical IN (SELECT canonical FROM listed) THEN 'block'
       ELSE 'allow' END AS verdict
FROM ruled
"""
