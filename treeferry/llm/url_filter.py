"""URL rules found through the rarest literal token of their pattern.

A rule is a regular expression with the literal tokens that any matching URL must contain.
Each rule is filed under that one of its tokens which the fewest URLs contain. The tokens
of a URL fetch the rules filed under them, and only these run their expression.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeferry.llm.columns import LiteralIndex, ascii_lower, let

#: The rules travel inside the plan; a longer list is refused, not cut.
MOST_RULES = 20_000


@dataclass(frozen=True)
class Rule:
    """``pattern`` (Java syntax) is searched in host and path, joined. Of the rules that
    match, the one of the highest ``rank`` decides, then the greatest ``name``."""

    name: str
    pattern: str
    verdict: str
    tokens: tuple[str, ...]
    rank: int
    listed: bool = False


def _tokens(literal: str) -> list[str]:
    return [t for t in re.split("[^a-z0-9]+", literal.lower()) if t]


def site_rule(name: str, verdict: str) -> Rule:
    """A rule ``host/path``: it fits the host and its subdomains where the path starts
    with the rule's. Longer ones rank higher, and all rank above word rules."""
    host, slash, path = name.partition("/")
    whole = re.sub("[A-Za-z0-9]+$", "", slash + path)  # the last token may go on in the URL
    pattern = rf"^(?:[^/]*\.)?{_quoted(host)}{_quoted(slash + path)}"
    return Rule(name, pattern, verdict, tuple(_tokens(host) + _tokens(whole)), 1000 + len(name), listed=True)


def word_rule(word: str, verdict: str = "block") -> Rule:
    """A rule for URLs that contain a word, delimited by anything but letters and digits."""
    return Rule(word, rf"(?i)(?:^|[^a-z0-9]){_quoted(word)}(?:[^a-z0-9]|$)", verdict, tuple(_tokens(word)), 1)


def _quoted(literal: str) -> str:
    return re.sub(r"([^A-Za-z0-9/_])", r"\\\1", literal)


# The listed sites.
SITE_RULES = (
    site_rule("org/", "allow"),
    site_rule("example.org/es/", "block"),
    site_rule("example.org/en/1", "block"),
    site_rule("com/fr/", "allow"),
    site_rule("com/de/", "block"),
)
#: What decides about sites that are not listed: words of pages without prose.
WORD_RULES = tuple(
    word_rule(word)
    for word in (
        "login", "signin", "signup", "logout", "register", "cart", "checkout", "cgi-bin", "wp-admin", "wp-login",
        "casino", "poker", "betting", "porn", "xxx", "viagra",
    )
)
RULES = SITE_RULES + WORD_RULES


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    whole = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(whole, "://")
    return F.when(at > 0, F.substring(whole, at + 3, F.length(whole))).otherwise("")


def url_tokens(text: Column) -> Column:
    """The different literal tokens of a text, in lower case."""
    return F.array_distinct(F.array_remove(F.split(ascii_lower(text), "[^a-z0-9]+"), ""))


def token_counts(texts: DataFrame, rules: Sequence[Rule]) -> dict[str, int]:
    """How many rows of the one-column ``texts`` contain each token of the rules. The
    result has no more rows than the rules have tokens."""
    names = sorted({token for rule in rules for token in rule.tokens})
    if not names:
        return {}
    held = F.filter(url_tokens(texts[texts.columns[0]]), lambda t: t.isin(names))
    counts = texts.select(F.explode(held).alias("token")).groupBy("token").count()
    return {row["token"]: row["count"] for row in counts.collect()}


def _filed(rules: Iterable[Rule], counts: dict[str, int]) -> dict[str, list[Rule]]:
    files: dict[str, list[Rule]] = {}
    for rule in rules:
        rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default="")
        files.setdefault(rarest, []).append(rule)
    return files


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, url: str = "url", default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule`` (the deciding
    listed rule or null), ``verdict``, and ``word`` (the deciding other rule or null).

    A first pass over the URLs alone counts the rules' tokens; it only chooses where rules
    are filed and never what they decide. The second has no shuffle: every row is judged
    where it is read, so hot hosts and repeated URLs do no harm. Null URLs, and those
    without ``://``, have an empty host and path, which match no rule that has a token.
    Other columns of ``pages``, whatever their names, are not read.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MOST_RULES} travel in a plan")
    targets = pages.select("page_id", host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    whole = F.concat("host", "path")
    files = _filed(rules, token_counts(targets.select(whole.alias("target")), rules))
    fields = "rank:int,name:string,verdict:string,listed:boolean,pattern:string"
    index = LiteralIndex(
        {token: [{f: getattr(rule, f) for f in ("rank", "name", "verdict", "listed", "pattern")} for rule in filed]
         for token, filed in files.items()},
        fields,
    )

    def deciding(target: Column) -> Column:
        tokens = F.concat(url_tokens(target), F.array(F.lit("")))  # rules without a token are filed under ""
        fetched = F.flatten(F.transform(tokens, index.find))
        return F.array_max(F.filter(fetched, lambda rule: F.regexp_like(target, rule["pattern"])))

    judged = targets.withColumn("best", let(whole, deciding))
    return judged.select(
        "page_id",
        "host",
        "path",
        F.when(F.col("best.listed"), F.col("best.name")).alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.when(~F.col("best.listed"), F.col("best.name")).alias("word"),
    )


def _sql_cases(rules: Iterable[Rule], value: str) -> str:
    ranked = sorted(rules, key=lambda rule: (rule.rank, rule.name), reverse=True)
    return " ".join(f"WHEN regexp_matches(host || path, '{r.pattern}') THEN '{getattr(r, value)}'" for r in ranked)


ORACLE = rf"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE {_sql_cases(SITE_RULES, "name")} END AS rule FROM p)
SELECT page_id, host, path, rule,
  CASE {_sql_cases(SITE_RULES, "verdict")} {_sql_cases(WORD_RULES, "verdict")} ELSE 'allow' END AS verdict,
  CASE WHEN rule IS NULL THEN CASE {_sql_cases(WORD_RULES, "name")} END END AS word FROM r
"""
