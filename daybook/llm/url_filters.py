"""URL filters: pattern rules indexed by their rarest literal token.

A rule is compiled to a regular expression and to the literal tokens (runs of
ASCII letters and digits) that every URL it fits must hold whole.  Each rule
is filed under the one of its tokens that the fewest URLs hold.  The tokens of
a URL fetch its candidate rules, and only those regular expressions run.  All
in DataFrame functions.

Two kinds of rules:

* ``site``: ``host/path``; fits its host and all subdomains when the path
  starts with the rule's.  The longest fitting site rule decides;
* ``pattern``: a text to be found in the URL, in which ``*`` stands for any
  run and ``^`` for a separator or either end.  It decides where no site rule
  fits.  A URL that nothing fits is allowed.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import handoff

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules up to this many are broadcast; more are joined in a shuffle.
MAX_BROADCAST_RULES = 50_000


@dataclass(frozen=True)
class Rule:
    text: str
    action: str          # allow or block
    kind: str = "site"   # site or pattern


#: The site rules of the contract.
SITE_RULES = (Rule("net/", "block"), Rule("example.net/en/", "allow"),
              Rule("example.com/de/", "block"), Rule("org/fr/", "allow"))
#: The method's own rules, for URLs without a site rule.
PATTERN_RULES = tuple(Rule(t, "block", "pattern") for t in (
    "^cheap-pills^", "^pills^", "^casino^", "^poker^", "^viagra^", "^replica-watches^",
    "^payday-loans^", "^free-download^", "^adult^", "^xxx^", "^porn^", "^betting^",
    "^click-here^", "^ads.*^banner^", "^affiliate^", "^warez^"))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def quoted(text: str) -> str:
    """``text`` as a literal of Java's regular expressions."""
    return re.sub(r"([^A-Za-z0-9\s])", lambda m: "\\" + m[1] if ord(m[1]) < 128 else m[1], text)


def compiled(rule: Rule) -> tuple[str, list[str]]:
    """Regular expression of a rule, and tokens that every fitting URL holds whole."""
    if rule.kind == "site":
        host, slash, path = rule.text.partition("/")
        host = host.lower()
        regex = rf"^(?:[^/]*\.)?{quoted(host)}" + (quoted(slash + path) if slash else "(?:/|$)")
        marked = f"^{host}" + (slash + path if slash else "^")
    else:
        marked = rule.text.lower()
        regex = "".join({"*": "(?s:.*)", "^": "(?:[^a-z0-9]|^|$)"}.get(c) or quoted(c) for c in marked)
    tokens = [m[0] for m in re.finditer(r"[a-zA-Z0-9]+", marked)
              if m.start() > 0 and m.end() < len(marked)
              and "*" not in (marked[m.start() - 1], marked[m.end()])]
    return regex, sorted({t.lower() for t in tokens})


def rules_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """``rule, action, kind, regex, tokens``, one row per rule."""
    rows = [(r.text, r.action, r.kind, *compiled(r)) for r in rules]
    structs = [F.struct(F.lit(t).alias("rule"), F.lit(a).alias("action"), F.lit(k).alias("kind"),
                        F.lit(x).alias("regex"),
                        F.array(*[F.lit(w) for w in w]).cast("array<string>").alias("tokens"))
               for t, a, k, x, w in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def tokens(text: Column) -> Column:
    """Distinct tokens of a text; the empty token stands for rules without any."""
    return F.array_distinct(F.split(ascii_lower(text), "[^a-z0-9]+"))


def judge(pages: DataFrame, rules: DataFrame, n_rules: int | None = None,
          url_col: str = "url") -> DataFrame:
    """``pages`` with ``host, path, rule, pattern, verdict`` (columns of these names are replaced).

    ``rules`` as :func:`rules_table` gives them; ``n_rules`` is their number,
    if known (it decides between broadcast and shuffle).  ``rule`` is the
    deciding site rule, ``pattern`` the longest fitting pattern.  Equal URLs
    are judged once.  Null URLs, and those without ``://``, have empty host
    and path and are judged by their text (null: allowed).
    """
    host, path = parts(F.col("_url"))
    pages = pages.drop("host", "path", "rule", "pattern", "verdict")
    small = n_rules is not None and n_rules <= MAX_BROADCAST_RULES
    # a token more, so that every URL fetches the rules that have no token
    urls = (pages.select(F.col(url_col).alias("_url")).where(F.col("_url").isNotNull()).distinct()
            .withColumn("_token", F.explode(F.array_union(tokens(F.col("_url")), F.array(F.lit(""))))))
    rule_tokens = rules.select("rule", "kind", F.explode_outer("tokens").alias("_token")).select(
        "rule", "kind", F.coalesce("_token", F.lit("")).alias("_token"))
    wanted = rule_tokens.select("_token").distinct()
    held = (urls.join(F.broadcast(wanted) if small else wanted, "_token")
            .groupBy("_token").agg(F.count("*").alias("_n")))
    filed = (rule_tokens.join(held, "_token", "left").groupBy("rule", "kind")
             .agg(F.min_by("_token", F.struct(F.coalesce("_n", F.lit(0)), "_token")).alias("_token")))
    index = rules.drop("tokens").join(filed, ["rule", "kind"])
    target = F.when(F.col("kind") == "site", F.concat(host, path)).otherwise(ascii_lower(F.col("_url")))
    best = (urls.join(F.broadcast(index) if small else index, "_token")
            .where(F.rlike(target, F.col("regex"))))
    found = F.struct(F.length("rule").alias("n"), F.col("rule").alias("rule"), F.col("action").alias("action"))
    best = handoff(best.groupBy("_url").agg(
        F.max(F.when(F.col("kind") == "site", found)).alias("_site"),
        F.max(F.when(F.col("kind") != "site", found)).alias("_pattern")), "url-verdicts")
    host, path = parts(F.col(url_col))
    return (pages.join(best, F.col(url_col) == F.col("_url"), "left")
            .select(*[F.col(f"`{c}`") for c in pages.columns], host.alias("host"), path.alias("path"),
                    F.col("_site.rule").alias("rule"), F.col("_pattern.rule").alias("pattern"),
                    F.coalesce("_site.action", "_pattern.action", F.lit("allow")).alias("verdict")))
