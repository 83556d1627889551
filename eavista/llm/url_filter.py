"""URL filter: ordered host rules, then a list of canonical URLs behind a blocked Bloom filter.

The filter has a fixed size, ``2 ** block_bits`` blocks of 512 bits, whatever the list's length, so
sending it to every task is safe; a longer list only lets more URLs through to the exact join. The
blocks are built by an aggregation over the list. URLs that hit the filter are joined with the list,
which removes false positives; all others never take part in a join.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no rule and is
not on the list (verdict allow); repeated pages and repeated list entries change nothing; an empty
list blocks nothing. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from eavista.llm import bloom
from eavista.llm.common import ascii_lower

BLOCK_BITS = 14
#: Query parameters that name a visit, not a page.
TRACKING = "utm_[a-z]+|ref|fbclid|gclid"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the production query.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
#: Words in a host that put its pages on the derived list.
LISTED_WORDS = ("adult", "ads", "bets", "casino", "pills", "spam")


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return ascii_lower(found)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*(/[^?#]*)", 1)


def canonical_of(url: Column) -> Column:
    """Host, path without a last ``/``, and the query without tracking parameters; null without a host."""
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(query, f"(^|&)({TRACKING})=[^&]*", "")
    query = F.regexp_replace(query, "^&+", "")
    return F.when(
        host != "",
        F.concat(host, F.regexp_replace(path, "/+$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")),
    )


def fits(host: Column, path: Column, rule: Rule) -> Column:
    own = (host == rule.host) | host.endswith("." + rule.host)
    return own & path.startswith(rule.path)


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, the earlier one of two equally long; else null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.text)):
        hit = fits(host, path, rule)
        text = F.when(hit, F.lit(rule.text)).otherwise(text)
        verdict = F.when(hit, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def listed_pattern(words: Sequence[str] = LISTED_WORDS) -> str:
    return r"(^|\.)([a-z0-9]+-)*(" + "|".join(words) + r")(-[a-z0-9]+)*\."


def listed_hosts(pages: DataFrame, words: Sequence[str] = LISTED_WORDS) -> DataFrame:
    """A list of canonical URLs: all pages on hosts with one of ``words`` in a dash-separated label."""
    host = host_of(pages["url"])
    return pages.filter(host.rlike(listed_pattern(words)) & host.contains("-")).select(
        canonical_of(pages["url"]).alias("canonical")
    ).distinct()


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = RULES, block_bits: int = BLOCK_BITS) -> DataFrame:
    """page_id, host, path, rule, verdict, listed for every page. ``listed`` has a column canonical."""
    maybe = bloom.tester(pages.sparkSession, bloom.build(listed, "canonical", block_bits))
    url = pages["url"].cast("string")
    host, path = host_of(url), path_of(url)
    rule, verdict = longest_rule(host, path, rules)
    seen = pages.select(
        pages["page_id"].alias("page_id"), host.alias("host"), path.alias("path"), rule.alias("rule"),
        verdict.alias("rule_verdict"), canonical_of(url).alias("canonical"),
        maybe(canonical_of(url)).alias("maybe"),
    )
    possible = seen.filter("maybe")
    exact = (
        possible.select("canonical").distinct()
        .join(listed.select("canonical").distinct(), "canonical", "left_semi")
        .select(F.col("canonical").alias("hit_url"))
    )
    confirmed = possible.join(exact, F.col("canonical") == F.col("hit_url"), "left").withColumn(
        "listed", F.col("hit_url").isNotNull()
    ).drop("hit_url")
    both = confirmed.unionByName(seen.filter("NOT maybe").withColumn("listed", F.lit(False)))
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return both.select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", method).alias("verdict"), "listed"
    )
