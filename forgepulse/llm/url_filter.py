"""URL filters: allow and block rules, then a weighted vocabulary."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgepulse.llm.common import ascii_lower

# (host, path, verdict)
RULES = (
    ("net", "/", "block"), ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
)
# One of these rejects a page.
STRICT = (
    "camgirl", "camgirls", "hentai", "malware", "milf", "phishing", "porn", "porno", "pornhub",
    "ransomware", "warez", "xvideos", "xxx",
)
# Several different ones of these reject a page.
SOFT = (
    "adult", "bet", "betting", "bonus", "cam", "cams", "casino", "cheap", "click", "crack",
    "dating", "escort", "farm", "free", "gambling", "hot", "jackpot", "keygen", "loan", "loans",
    "naked", "nude", "payday", "pills", "poker", "prize", "seo", "sex", "sexy", "slots", "spam",
    "teen", "torrent", "viagra", "win", "winner",
)
SOFT_LIMIT = 2

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, URL, 1)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def rule_name(rule: Sequence[str]) -> str:
    return rule[0] + rule[1]


def _fits(rule: Sequence[str]) -> Column:
    at, below = F.col("host"), F.col("path").startswith(rule[1])
    return ((at == rule[0]) | at.endswith("." + rule[0])) & below


def longest_first(rules: Sequence[Sequence[str]]) -> list[Sequence[str]]:
    """Of rules of equal length, which can't be equal, the longer host goes first."""
    return sorted(rules, key=lambda rule: (-len(rule_name(rule)), -len(rule[0]), rule))


def count_terms(strict: Sequence[str], soft: Sequence[str]):
    """A function of a URL: how many different strict and soft terms stand in it alone.

    One pass of an Aho-Corasick automaton over the URL finds every term, overlapping
    ones too; a hit counts if neither neighbour is a letter or digit of ASCII.
    """
    terms = sorted({(term, True) for term in strict} | {(term, False) for term in soft})

    @F.pandas_udf("strict_hits int, soft_hits int")
    def counted(urls: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term, is_strict in terms:
            automaton.add_word(term, (term, is_strict))
        if terms:
            automaton.make_automaton()
        inner = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")

        def of(url: str | None) -> tuple[int, int]:
            if not url or not terms:
                return 0, 0
            hits = set()
            for end, (term, is_strict) in automaton.iter(url):
                start = end - len(term)
                if (start < 0 or url[start] not in inner) and url[end + 1:end + 2] not in inner:
                    hits.add((term, is_strict))
            strictly = sum(is_strict for _, is_strict in hits)
            return strictly, len(hits) - strictly

        for batch in urls:
            yield pd.DataFrame([of(url) for url in batch], columns=["strict_hits", "soft_hits"])

    return counted


def judge(
    pages: DataFrame, rules: Sequence[Sequence[str]] = RULES, strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT, soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """The rows of `pages` with host, path, the rule that fits, hits and the verdict.

    The longest fitting rule decides; without one a page is blocked by one strict term or
    `soft_limit` different soft ones. A null URL, or one without `://`, has an empty host
    and path: no rule fits it, and its terms still count. Rules and vocabulary are small
    fixed lists and go into the plan; no row is shuffled. Repeated pages are judged alike, and
    an empty table gives an empty result. Columns named as the results are replaced.
    """
    lowered = pages.withColumns({
        "host": host(F.col("url")), "path": path(F.col("url")),
        "__hits": count_terms(strict, soft)(ascii_lower(F.col("url"))),
    })
    ordered = longest_first(rules)
    none = F.lit(None).cast("string")
    fitting = reduce(
        lambda rest, rule: F.when(_fits(rule), F.lit(rule_name(rule))).otherwise(rest),
        reversed(ordered), none,
    )
    by_rule = reduce(
        lambda rest, rule: F.when(F.col("rule") == rule_name(rule), F.lit(rule[2])).otherwise(rest),
        reversed(ordered), none,
    )
    rejected = (F.col("strict_hits") >= 1) | (F.col("soft_hits") >= soft_limit)
    by_terms = F.when(rejected, "block").otherwise("allow")
    return (
        lowered.withColumns({
            "strict_hits": F.col("__hits.strict_hits"), "soft_hits": F.col("__hits.soft_hits"),
            "rule": fitting,
        })
        .drop("__hits")
        .withColumn("verdict", F.coalesce(by_rule, by_terms))
    )


def oracle(
    rules: Sequence[Sequence[str]] = RULES, strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT, soft_limit: int = SOFT_LIMIT,
) -> str:
    """The same in SQL: a regular expression for each term, one branch for each rule."""
    def hits(terms: Sequence[str]) -> str:
        return " + ".join(
            f"(regexp_matches(lowered, '(^|[^a-z0-9]){term}([^a-z0-9]|$)'))::int"
            for term in sorted(set(terms))
        )

    fits = [
        (f"(host = '{at}' or ends_with(host, '.{at}')) and starts_with(path, '{below}')",
         f"{at}{below}", verdict)
        for at, below, verdict in longest_first(rules)
    ]
    rule = " ".join(f"when {when} then '{name}'" for when, name, _ in fits)
    verdict = " ".join(f"when {when} then '{verdict}'" for when, _, verdict in fits)
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
with parts as (
  select page_id,
    coalesce({lower.format(f"regexp_extract(url, '{URL}', 1)")}, '') as host,
    coalesce(regexp_extract(url, '{URL}', 2), '') as path,
    coalesce({lower.format("url")}, '') as lowered
  from pages
), counted as (
  select *, cast({hits(strict)} as int) as strict_hits, cast({hits(soft)} as int) as soft_hits
  from parts
)
select page_id, host, path, case {rule} end as rule, strict_hits, soft_hits,
  case {verdict} when strict_hits >= 1 or soft_hits >= {soft_limit} then 'block'
    else 'allow' end as verdict
from counted
"""
