"""URL rules: many patterns, few of which run on any one URL.

Each rule is a regular expression with literal tokens (runs of A-Z, a-z, 0-9) that every
URL it matches must hold.  The token that the fewest URLs hold indexes the rule; a URL's
own tokens fetch its candidate rules, and only their expressions run.  Host rules and free
patterns live in the same index.

Only DataFrame functions: the rule table joins the URLs' tokens, one row for each distinct
URL and token.  Spark broadcasts the rules while they are small and else shuffles both.

Nulls and texts without ``://`` have empty host and path, no tokens and so no rule.
Repeated URLs are judged once and every row comes back.  Columns beside the two named ones
do not take part.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quoteloom.llm.common import lower_ascii

RULE_SCHEMA = "name string, verdict string, pattern string, tokens array<string>, weight int"


@dataclass(frozen=True)
class Rule:
    """``pattern`` runs on ``host + rest``; of the rules that match, the heaviest decides."""

    name: str
    verdict: str
    pattern: str
    tokens: Sequence[str]
    weight: int


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """A host, its subdomains and the paths that start with ``path``; longer texts weigh more."""
    text = host + path
    tokens = sorted(set(re.findall("[a-z0-9]+", text.lower())))
    return Rule(text, verdict, f"^(?:[^/?#]*\\.)?{re.escape(text)}", tokens, 1_000_000 + len(text))


def pattern_rule(verdict: str, name: str, pattern: str, tokens: Sequence[str]) -> Rule:
    """A free pattern, which counts where no host rule fits; ``tokens`` occur in all it matches."""
    return Rule(name, verdict, pattern, tokens, len(pattern))


def address(url: Column) -> Column:
    """What follows the first ``://``; null without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(address(url), "^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(address(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def target_of(url: Column) -> Column:
    """What patterns see: the host in lower case and all after it."""
    rest = F.regexp_extract(address(url), r"^[^/?#]*([\s\S]*)$", 1)
    return F.concat(host_of(url), F.coalesce(rest, F.lit("")))


def rule_index(urls: DataFrame, tokens: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rules, each under the one of its tokens that is rarest over all URLs."""
    spark = urls.sparkSession
    rows = [(r.name, r.verdict, r.pattern, list(r.tokens), r.weight) for r in rules]
    listed = spark.createDataFrame(rows, RULE_SCHEMA)
    by_token = listed.select("name", F.explode("tokens").alias("token"))
    counts = tokens.join(by_token.select("token").distinct(), "token", "left_semi")
    counts = counts.groupBy("token").agg(F.count("*").alias("n"))
    rarest = (
        by_token.join(counts, "token", "left")
        .groupBy("name")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "token"))["token"].alias("token"))
    )
    return listed.join(rarest, "name").select("name", "verdict", "pattern", "weight", "token")


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    *,
    id: str = "page_id",
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``id``, ``url``, host, path, rule (the name of the deciding one, or null) and verdict."""
    rows = pages.select(F.col(f"`{id}`").alias("id"), F.col(f"`{url}`").alias("url"))
    urls = rows.select("url").where(F.instr("url", "://") > 0).distinct()
    urls = urls.select("url", target_of(F.col("url")).alias("target"))
    words = F.array_distinct(F.split(lower_ascii(F.col("target")), "[^a-z0-9]+"))
    tokens = urls.select("url", "target", F.explode(words).alias("token"))
    index = rule_index(urls, tokens.select("token"), rules)
    best = (
        tokens.join(index, "token")
        .where(F.expr("target RLIKE pattern"))
        .groupBy("url")
        .agg(F.max(F.struct("weight", "name", "verdict")).alias("best"))
    )
    return rows.join(best, "url", "left").select(
        F.col("id").alias(id),
        F.col("url").alias(url),
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        F.col("best.name").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


# The lists of the registered query.
HOST_RULES = [
    host_rule("block", "net", "/"),
    host_rule("allow", "example.net", "/en/"),
    host_rule("block", "example.com", "/de/"),
    host_rule("allow", "org", "/fr/"),
]
PATTERN_RULES = [
    pattern_rule("block", "session id", r"[?&](?i:phpsessid)=", ["phpsessid"]),
    pattern_rule("block", "login page", r"^[^?#]*/(?i:login)(?:[/?#.]|$)", ["login"]),
    pattern_rule("block", "sign-up page", r"^[^?#]*/(?i:signup)(?:[/?#.]|$)", ["signup"]),
    pattern_rule("block", "shopping cart", r"^[^?#]*/(?i:cart)(?:[/?#]|$)", ["cart"]),
    pattern_rule("block", "advert server", r"^(?:[^/?#]*\.)?adserver\.", ["adserver"]),
    pattern_rule("block", "executable", r"^[^?#]*\.(?i:exe)$", ["exe"]),
]
