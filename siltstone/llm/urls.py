"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a host with a path prefix, or a regular expression with the literal tokens that every match must hold.  Of a
literal that may stand inside a longer token, its pieces of three characters are the tokens.  How often each of these
tokens occurs is counted over all URLs, and a rule is filed under its rarest one.  Only the rules filed under a token
of a URL are tried on it: host and path are compared as columns, patterns by expression.  The longest host and path
rule wins, and any of them beats the patterns, whose first fit in the order of the list decides.

Up to ``LITERAL_RULES`` rules stand in the plan: counting is one combined aggregation over their tokens, judging a map
without a shuffle, and their expressions are compiled once.  A longer list - block lists have 10^5 rules - is a table:
tokens of the distinct URLs are joined with the index, the fits of a URL are combined before the shuffle, and
verdicts are joined back by URL.  Both give the same verdicts; Spark broadcasts the table where its size allows.

Defined results: a null URL, or one without ``://``, has an empty host and path, so no host rule fits; a null URL has
no tokens and gets the default verdict; rows that repeat are judged alike; an empty table gives an empty result; input
columns with the names of added ones are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.text import ASCII_UPPER
from siltstone.storage import materialize

#: Rules that stand in the plan; longer lists are joined as a table.
LITERAL_RULES = 300
ADDED = ("host", "path", "rule", "verdict", "pattern")
#: Rules by host and path.
SITE_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
DEFAULT = "allow"
PIECE = 3


def read_patterns(path: str | Path) -> tuple[tuple[str, str, tuple[str, ...]], ...]:
    """(name, expression, tokens) from lines of name, tokens and expression with tabs between; # begins a comment."""
    rows = [line.split("\t") for line in Path(path).read_text().splitlines() if line and not line.startswith("#")]
    return tuple((name, pattern, tuple(needs.split())) for name, needs, pattern in rows)


#: Further blocks by pattern, in order.
PATTERN_RULES = read_patterns(Path(__file__).with_name("url_patterns.tsv"))


@dataclass(frozen=True)
class UrlRule:
    """A site rule has a host and a path prefix, any other rule a pattern; the smallest rank wins."""

    name: str
    verdict: str
    tokens: tuple[str, ...]
    rank: int
    host: str | None = None
    prefix: str | None = None
    pattern: str | None = None


def lowered(url: Column) -> Column:
    return F.translate(F.coalesce(url, F.lit("")), ASCII_UPPER, ASCII_UPPER.lower())


def host(url: Column) -> Column:
    return lowered(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(text, "[^a-z0-9]+"), lambda t: t != ""))


def pieces(found: Column) -> Column:
    """All runs of ``PIECE`` characters in the tokens, between stars so that they differ from whole tokens."""
    of = F.transform(F.filter(found, lambda t: F.length(t) >= PIECE), lambda t: F.transform(F.sequence(F.lit(1), F.length(t) - PIECE + 1), lambda i: F.concat(F.lit("*"), F.substr(t, i, F.lit(PIECE)), F.lit("*"))))
    return F.array_distinct(F.flatten(of))


def _indexed(needs: tuple[str, ...]) -> tuple[str, ...]:
    """The tokens to file a rule under: whole ones as they are, the pieces of one between stars."""
    inner = [t.strip("*") for t in needs if "*" in t]
    return tuple(t for t in needs if "*" not in t) + tuple(f"*{t[i:i + PIECE]}*" for t in inner for i in range(len(t) - PIECE + 1))


def _site_tokens(at: str, prefix: str) -> tuple[str, ...]:
    """Tokens of the host, and those of the path that end within the rule, since a longer one may follow its end."""
    ended = re.split("[^a-z0-9]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in prefix))[:-1]
    return tuple(dict.fromkeys(t for t in (*re.split("[^a-z0-9]+", at), *ended) if t))


def compile_rules(site: tuple[tuple[str, str], ...] = SITE_RULES, patterns: tuple[tuple[str, str, tuple[str, ...]], ...] = PATTERN_RULES) -> list[UrlRule]:
    """Site rules, the longest first, then the patterns; each needs a literal token."""
    out = []
    for verdict, rule in sorted(dict.fromkeys(site), key=lambda r: (-len(r[1]), r[1])):
        at, prefix = rule.split("/", 1)
        out.append(UrlRule(rule, verdict, _site_tokens(at, prefix), len(out), host=at, prefix="/" + prefix))
    for name, pattern, needs in patterns:
        out.append(UrlRule(name, "block", _indexed(needs), len(out), pattern=pattern))
    bare = [r.name for r in out if not r.tokens]
    if bare:
        raise ValueError(f"rules without a literal token: {bare[:5]}")
    return out


def _site_fits(at: Column, prefix: Column) -> Column:
    own = F.col("host")
    return ((own == at) | own.endswith(F.concat(F.lit("."), at))) & F.col("path").startswith(prefix)


def _seen(url: Column, inner: bool) -> dict[str, Column]:
    whole = tokens(F.concat_ws(" ", host(url), lowered(url)))
    return {"host": host(url), "path": path(url), "_low": lowered(url), "_whole": whole, "_pieces": pieces(F.col("_whole")) if inner else F.array().cast("array<string>")}


def filter_urls(pages: DataFrame, url_col: str = "url", rules: list[UrlRule] | None = None, default: str = DEFAULT, literal_rules: int = LITERAL_RULES) -> DataFrame:
    """The input rows with ``host``, ``path``, the site ``rule`` that fits, the ``pattern`` that fits, and ``verdict``."""
    rules = compile_rules() if rules is None else rules
    kept = [c for c in pages.columns if c not in ADDED]
    picked = pages.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(kept)], F.col(f"`{url_col}`").alias("_url"))
    judged = (_by_literals if len(rules) <= literal_rules else _by_table)(picked, rules)
    verdict = F.coalesce(F.col("_site.verdict"), F.col("_pattern.verdict"), F.lit(default))
    return judged.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(kept)], "host", "path", F.col("_site.name").alias("rule"), verdict.alias("verdict"), F.col("_pattern.name").alias("pattern"))


def _by_literals(picked: DataFrame, rules: list[UrlRule]) -> DataFrame:
    needed = sorted({t for r in rules for t in r.tokens})
    made = _seen(F.col("_url"), any("*" in t for t in needed))
    whole = picked.select("*", *[made[c].alias(c) for c in ("host", "path", "_low", "_whole")])
    seen = whole.select("*", F.concat("_whole", made["_pieces"]).alias("_tokens"))
    mine = seen.select(F.explode(F.array_intersect("_tokens", F.array(*map(F.lit, needed)))).alias("t"))
    counted = {r["t"]: r["n"] for r in mine.groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per rule token
    filed = {r.rank: min(r.tokens, key=lambda t: (counted.get(t, 0), t)) for r in rules}
    held = F.array_intersect("_tokens", F.array(*map(F.lit, sorted(set(filed.values())))))
    fetched = seen.select(*[c for c in picked.columns], "host", "path", "_low", held.alias("_held"))

    def first(of: list[UrlRule]) -> Column:
        """The first of these rules that is filed under a token of the URL and fits."""
        out = F.lit(None).cast("struct<name:string,verdict:string>")
        for r in reversed(of):
            fits = _site_fits(F.lit(r.host), F.lit(r.prefix)) if r.pattern is None else F.col("_low").rlike(r.pattern)
            out = F.when(F.array_contains("_held", filed[r.rank]) & fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
        return F.when(F.size("_held") > 0, out)

    ranked = sorted(rules, key=lambda r: r.rank)
    return fetched.select("*", first([r for r in ranked if r.pattern is None]).alias("_site"), first([r for r in ranked if r.pattern is not None]).alias("_pattern"))


def _by_table(picked: DataFrame, rules: list[UrlRule]) -> DataFrame:
    spark = picked.sparkSession
    listed = spark.createDataFrame([(r.rank, r.name, r.verdict, r.host, r.prefix, r.pattern, list(r.tokens)) for r in rules], "rank int, name string, verdict string, at string, prefix string, pattern string, tokens array<string>")
    table = materialize(listed, "url-rules")
    inner = any("*" in t for r in rules for t in r.tokens)
    urls = materialize(picked.where(F.col("_url").isNotNull()).select("_url").distinct(), "urls")
    made = _seen(F.col("_url"), inner)
    held = urls.select("_url", made["_whole"].alias("_whole")).select("_url", F.explode(F.concat("_whole", made["_pieces"])).alias("t"))
    of_rules = table.select("rank", F.explode("tokens").alias("t"))
    held = materialize(held.join(of_rules.select("t").distinct(), "t", "left_semi"), "url-tokens")
    counted = held.groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    rarest = of_rules.join(counted, "t", "left").groupBy("rank").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "t"))["t"].alias("t"))
    index = table.drop("tokens").join(rarest, "rank")
    tried = held.join(index, "t").select("_url", host(F.col("_url")).alias("host"), path(F.col("_url")).alias("path"), "rank", "name", "verdict", "at", "prefix", "pattern")
    fits = F.when(F.col("pattern").isNull(), _site_fits(F.col("at"), F.col("prefix"))).otherwise(F.rlike(lowered(F.col("_url")), F.col("pattern")))
    says = F.struct("rank", "name", "verdict")
    found = tried.where(fits).groupBy("_url").agg(F.min(F.when(F.col("pattern").isNull(), says)).alias("_site"), F.min(F.when(F.col("pattern").isNotNull(), says)).alias("_pattern"))
    return picked.join(found, "_url", "left").select(*picked.columns, host(F.col("_url")).alias("host"), path(F.col("_url")).alias("path"), "_site", "_pattern")
