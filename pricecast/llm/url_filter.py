"""URL verdicts by pattern rules that are indexed by their rarest literal token.

Every rule is a regular expression with literal tokens that any matching URL must hold. The tokens of all rules are
counted over the URLs, a rule is filed under the one that fewest URLs hold, and a URL's own tokens fetch the few rules
that could match; only those run. DataFrame expressions throughout: no shuffle beyond the token counts.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPLIT_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
NOT_TOKEN = "[^A-Za-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """A regular expression over host and path joined, its verdict, and tokens that a match must hold."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits the host and its subdomains where the URL's path starts with the given one."""
    text = host + path
    whole = [m.group() for m in re.finditer("[A-Za-z0-9]+", text) if m.end() < len(text)]  # the last may go on
    quoted = re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)
    return Rule(text, verdict, f"(?s)^(?:[^/]*\\.)?{quoted}.*", tuple(whole))


def word_rule(verdict: str, word: str) -> Rule:
    """Fits a word between punctuation anywhere in host or path."""
    return Rule(word, verdict, f"(?s)^(?:.*[^A-Za-z0-9])?{word}(?:[^A-Za-z0-9].*)?$", (word,))


#: Words in addresses of gambling, pill and adult sites.
GENERAL = [word_rule("block", w) for w in "casino poker bets betting lottery pills pharmacy viagra xxx porn adult escort".split()]


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for null or without ``://``."""
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, SPLIT_URL, 1), UPPER, LOWER), F.regexp_extract(url, SPLIT_URL, 2)


class Index:
    """Rules by rarest token. ``rules`` are given by the caller, so their number does not grow with the table."""

    def __init__(self, urls: DataFrame, rules: Sequence[Rule]):
        """urls: a column ``tokens`` of distinct tokens a URL."""
        self.rules = sorted(rules, key=lambda r: (-len(r.name), r.name))  # the first that matches is the longest
        named = sorted({t for r in self.rules for t in r.tokens})
        held = urls.select(F.explode(F.array_intersect("tokens", F.array(*map(F.lit, named)).cast("array<string>"))).alias("t"))
        count = {r.t: r.n for r in held.groupBy("t").agg(F.count("*").alias("n")).collect()} if named else {}  # a row a rule token
        self.by_token: dict[str, list[int]] = {}
        self.always: list[int] = []
        for i, r in enumerate(self.rules):
            if r.tokens:
                self.by_token.setdefault(min(r.tokens, key=lambda t: (count.get(t, 0), t)), []).append(i)
            else:
                self.always.append(i)

    def best(self, tokens: Column, subject: Column) -> Column:
        """Number of the longest rule that matches, or null; only the rules that the tokens fetch are run."""
        ints = lambda xs: F.array(*map(F.lit, xs)).cast("array<int>")
        found = ints(self.always)
        if self.by_token:
            filed = F.create_map(*[c for t, xs in self.by_token.items() for c in (F.lit(t), ints(xs))])
            mine = F.array_intersect(tokens, F.array(*map(F.lit, self.by_token)))
            found = F.concat(found, F.flatten(F.transform(mine, lambda t: filed[t])))
        patterns = F.array(*[F.lit(r.pattern) for r in self.rules]).cast("array<string>")
        return F.array_min(F.filter(found, lambda i: F.regexp_like(subject, patterns[i])))

    def field(self, number: Column, name: str) -> Column:
        return F.array(*[F.lit(getattr(r, name)) for r in self.rules]).cast("array<string>")[number]


def judge(pages: DataFrame, rules: Sequence[Rule], general: Sequence[Rule] = tuple(GENERAL), url_col: str = "url") -> DataFrame:
    """Adds host, path, rule and verdict to every row; columns of those names are replaced.

    The longest given rule that fits decides and is named; else the general rules decide, and no match allows. A null
    or malformed URL has an empty host and path and is allowed. Rows may repeat; an empty table stays empty.
    """
    host, path = parts(F.col(url_col))
    split = pages.withColumn("host", host).withColumn("path", path)
    split = split.withColumn("_subject", F.concat("host", "path")).withColumn("_tokens", F.array_distinct(F.split("_subject", NOT_TOKEN)))
    urls = split.select(F.col("_tokens").alias("tokens"))
    given, other = Index(urls, rules), Index(urls, general)
    out = split.withColumn("_given", given.best(F.col("_tokens"), F.col("_subject")))
    out = out.withColumn("_other", other.best(F.col("_tokens"), F.col("_subject")))
    return (
        out.withColumn("rule", given.field(F.col("_given"), "name"))
        .withColumn("verdict", F.coalesce(given.field(F.col("_given"), "verdict"), other.field(F.col("_other"), "verdict"), F.lit("allow")))
        .drop("_subject", "_tokens", "_given", "_other")
    )
