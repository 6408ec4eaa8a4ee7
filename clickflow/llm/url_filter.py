"""URL filtering: listed host rules first, then a weighted vocabulary found by Aho-Corasick.

The automaton finds every term of the vocabulary in the lower-cased URL. A hit counts when no
letter or digit touches it on either side. One strict term, or ``SOFT_NEEDED`` different soft
terms, reject the URL. A rule (host, path) fits its host and all its subdomains when the URL's
path starts with the rule's; the longest fitting rule overrides the vocabulary.

Defined results: a null URL, or one without ``://``, has empty host and path, no rule, and is
judged by the vocabulary over what text there is; an empty table gives an empty table.
Every row is judged alone, so repeated rows repeat their verdict.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickflow.llm.common import ascii_lower, replace_columns, table

STRICT = ("camgirls", "escorts", "hentai", "malware", "nsfw", "phishing", "porn", "porno", "pornstar",
          "spam", "viagra", "warez", "xxx")
SOFT = ("ad", "ads", "adult", "babes", "bet", "bets", "betting", "bonus", "casino", "cheap", "cracked",
        "dating", "deals", "farm", "free", "gambling", "hot", "jackpot", "loans", "lottery", "pharma",
        "pills", "poker", "popup", "replica", "sex", "sexy", "singles", "slots", "track", "tracker",
        "tracking", "webcam", "win", "x")
SOFT_NEEDED = 2
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"),
         ("org/fr/", "allow"))


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def automaton(strict, soft) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, terms in (("soft", soft), ("strict", strict)):
        for term in terms:
            found.add_word(term, (term, kind))
    found.make_automaton()
    return found


def vocabulary_hits(terms: ahocorasick.Automaton, url: str) -> tuple[int, int]:
    """How many different strict and soft terms stand in the URL with boundaries."""
    hits = {"strict": set(), "soft": set()}
    for last, (term, kind) in terms.iter(url):
        first = last - len(term) + 1
        if not (first and url[first - 1].isalnum()) and not url[last + 1:last + 2].isalnum():
            hits[kind].add(term)
    return len(hits["strict"]), len(hits["soft"])


def longest_rule(by_host: dict, host: str, path: str):
    """The longest rule for the host or a domain above it whose path starts this path."""
    best = (None, None)
    labels = host.split(".")
    for k in range(len(labels)):
        domain = ".".join(labels[k:])
        for start, rule, verdict in by_host.get(domain, ()):
            if path.startswith(start) and (best[0] is None or len(rule) > len(best[0])):
                best = (rule, verdict)
    return best


def judge(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT,
          soft_needed: int = SOFT_NEEDED) -> DataFrame:
    """Pages with ``host, path, rule, verdict, strict_hits, soft_hits``."""
    by_host: dict[str, list] = {}
    for rule, verdict in rules:
        host, slash, rest = rule.partition("/")
        by_host.setdefault(host, []).append((slash + rest, rule, verdict))

    @F.pandas_udf("rule string, verdict string, strict_hits bigint, soft_hits bigint")
    def verdicts(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        terms = automaton(strict, soft)
        for urls, hosts, paths in parts:
            rows = []
            for url, host, path in zip(urls, hosts, paths):
                n_strict, n_soft = vocabulary_hits(terms, url)
                rule, verdict = longest_rule(by_host, host, path)
                bad = n_strict > 0 or n_soft >= soft_needed
                rows.append((rule, verdict or ("block" if bad else "allow"), n_strict, n_soft))
            yield pd.DataFrame(rows, columns=["rule", "verdict", "strict_hits", "soft_hits"])

    url = F.col("url")
    parts = replace_columns(pages, {"host": host_of(url), "path": path_of(url)})
    judged = parts.withColumn("__judged", verdicts(
        ascii_lower(F.coalesce(F.col("url"), F.lit(""))), F.col("host"), F.col("path")))
    return replace_columns(judged, {
        name: F.col(f"__judged.{name}")
        for name in ("rule", "verdict", "strict_hits", "soft_hits")}).drop("__judged")


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "pages").select("page_id", "url")).drop("url")


def _found(term: str) -> str:
    return f"regexp_matches(u, '(^|[^\\p{{L}}\\p{{N}}]){term}([^\\p{{L}}\\p{{N}}]|$)')::BIGINT"


ORACLE = rf"""
WITH p AS (
  SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
h AS (
  SELECT *, {' + '.join(map(_found, STRICT))} AS strict_hits,
    {' + '.join(map(_found, SOFT))} AS soft_hits,
    CASE
      WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
      WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
      WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
      WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/'
    END AS rule
  FROM p)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
       WHEN rule IS NOT NULL THEN 'allow'
       WHEN strict_hits > 0 OR soft_hits >= {SOFT_NEEDED} THEN 'block' ELSE 'allow' END AS verdict,
  strict_hits, soft_hits
FROM h
"""
