"""URL filters: pattern rules indexed by their rarest literal token. Column expressions only.

Every rule is a regular expression over host + path with literal tokens (runs of letters
and digits) that a URL must have to match. How often the tokens occur in the URLs is counted,
and each rule is filed under its rarest token. The tokens of a URL then fetch the few rules filed
under them, and only those run their expression. A rule without literal tokens is filed under
the empty token, which every URL then has.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A rule table above this size is not hinted for broadcast.
BROADCAST_BYTES = 8 << 20


@dataclass(frozen=True)
class UrlRule:
    """``pattern`` is searched in host + path; all of ``tokens`` must be whole tokens of what it finds.
    ``weight`` decides between matching rules, the larger wins; on ties block wins, then the later name."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    weight: int


def host_rule(verdict: str, host: str, path: str) -> UrlRule:
    """A host and all its subdomains, under paths that start with ``path``; the longest such rule wins.
    Tokens at the end of a path may go on in the URL, so they are left out."""
    tokens = [*re.findall("[a-z0-9]+", host.lower()), *re.findall("[a-z0-9]+(?=[^a-z0-9])", path.lower())]
    return UrlRule(
        host + path, verdict, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", tuple(tokens), len(host) + len(path)
    )


def host_words_rule(words: str) -> UrlRule:
    """Blocks hosts of which ``words`` (joined by hyphens) is a label or the hyphenated part of one."""
    return UrlRule(words, "block", rf"^(?:[^/]*[.-])?{re.escape(words)}(?:[.-][^/]*)?(?:/|$)", tuple(words.split("-")), len(words))


#: Hosts that name what they peddle.
UNWANTED_HOSTS = tuple(host_words_rule(w) for w in (
    "cheap-pills", "pills", "spam-farm", "spam", "casino", "viagra", "porn", "payday-loans", "replica-watches",
))


def _lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there
    up to ``?``, ``#`` or the end. Both empty for null and where there is no ``://``."""
    value = F.coalesce(url, F.lit(""))
    host = _lower(F.regexp_extract(value, r"://([^/?#]*)", 1))
    return host, F.regexp_extract(value, r"://[^/?#]*([^?#]*)", 1)


def _rule_table(df: DataFrame, rules: tuple[UrlRule, ...]) -> DataFrame:
    spark = df.sparkSession
    order = sorted(rules, key=lambda r: (r.weight, r.verdict == "block", r.name))
    rows = [(i, r.pattern, list(r.tokens) or [""]) for i, r in enumerate(order)]
    return spark.createDataFrame(rows, "rank long, pattern string, tokens array<string>")


def filtered(pages: DataFrame, rules: tuple[UrlRule, ...], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (the name of the winning rule, else null) and rule_verdict (its
    verdict, else null). Columns of ``pages`` with these names are replaced. Null URLs match nothing."""
    order = sorted(rules, key=lambda r: (r.weight, r.verdict == "block", r.name))
    host, path = host_and_path(F.col(url))
    pages = pages.withColumns({"host": host, "path": path}).drop("rule", "rule_verdict")
    if not rules:
        return pages.withColumns({"rule": F.lit(None).cast("string"), "rule_verdict": F.lit(None).cast("string")})
    tokens = F.split(_lower(F.concat("host", "path")), "[^a-z0-9]+")
    if not all(r.tokens for r in rules):
        tokens = F.concat(tokens, F.array(F.lit("")))
    tokens = F.array_distinct(tokens)
    rows = pages.withColumn("_row", F.monotonically_increasing_id()).withColumn("_token", F.explode(tokens))
    table = _rule_table(pages, rules)
    small = sum(len(r.pattern) + sum(map(len, r.tokens)) + 64 for r in rules) <= BROADCAST_BYTES
    hint = F.broadcast if small else (lambda df: df)

    literals = table.select("rank", "pattern", F.explode("tokens").alias("_literal"))
    seen = pages.select(F.explode(tokens).alias("_literal")).join(hint(literals.select("_literal").distinct()), "_literal")
    counts = seen.groupBy("_literal").agg(F.count("*").alias("_n"))
    rarest = F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("_n"), "_literal"))
    index = literals.join(counts, "_literal", "left").groupBy("rank", "pattern").agg(rarest.alias("_rarest")).select(
        "rank", "pattern", F.col("_rarest._literal").alias("_filed")
    )
    fetched = rows.join(hint(index), F.col("_token") == F.col("_filed"), "left")
    matched = F.when(F.expr("concat(host, path) RLIKE pattern"), F.col("rank"))
    names = pages.columns
    best = fetched.groupBy("_row", *names).agg(F.max(matched).alias("_rank"))
    # The names of a rule are looked up by its place in the table.
    at = (F.col("_rank") + 1).cast("int")
    verdicts = best.withColumns({
        "rule": F.when(at.isNotNull(), F.element_at(F.array(*[F.lit(r.name) for r in order]), at)),
        "rule_verdict": F.when(at.isNotNull(), F.element_at(F.array(*[F.lit(r.verdict) for r in order]), at)),
    })
    return verdicts.select(*names, "rule", "rule_verdict")
