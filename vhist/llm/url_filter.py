"""URL filter: pattern rules indexed by their rarest literal token.

Two kinds of rule: list rules, a host with a path prefix and a verdict, of
which the longest that fits decides; and pattern rules, regular expressions
that decide where no list rule fits (one that matches blocks, else the page is
allowed).  The literal tokens that any match of a pattern must contain are
derived from it; tokens given with it must be among them.  Every
rule is indexed under the one of its literal tokens that the fewest pages have;
a page's tokens fetch candidate rules by a join, and only candidates are tried.
Up to ``MAX_RULES`` rules are broadcast; more are joined by token and salt, so
that a token which most pages have is dealt over many tasks.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end; both are empty for
a null url or one without ``://``.

Defined cases: a null or empty url has no token, so no rule and verdict allow;
repeated rows are judged each; a rule whose tokens no page has is never tried;
rules without a literal token are tried on every page; an empty table gives no
row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vhist.llm.literals import forced_tokens

MAX_RULES = 100_000  # bound of the broadcast rule index
SALTS = 32  # parts of a token's pages where rules are not broadcast

# Host, path prefix, verdict.
LIST_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

# Regular expression over host and path, literal tokens that every match has (None: as derived).
PATTERN_RULES = [
    (r"(^|[.-])spam-[a-z0-9-]*\.", ["spam"]),
    (r"(^|\.)cheap-pills\.", ["cheap", "pills"]),
    (r"(^|[./-])(free-)?casino([./-]|$)", ["casino"]),
    (r"(^|[./-])free-download([./-]|$)", ["free", "download"]),
    (r"(^|[./-])xxx([./-]|$)", ["xxx"]),
]

_AFTER = r"(?s)^.*?://"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, _AFTER, "")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path


def _tokens(*texts: Column) -> Column:
    """Distinct runs of letters and digits, A-Z lower-cased (non-ASCII characters
    count as letters, but for line ends, before which a pattern's ``$`` matches)."""
    parts = F.split(F.lower(F.concat_ws("/", *texts)), r"[\x00-\x2F\x3A-\x60\x7B-\x7F\x{85}\x{2028}\x{2029}]+")
    return F.array_distinct(F.filter(parts, lambda t: t != ""))


def _rules(spark, list_rules, pattern_rules) -> DataFrame:
    rows = [(n, f"{h}{p}", h, p, v, None, None) for n, (h, p, v) in enumerate(list_rules)]
    for pattern, tokens in pattern_rules:
        forced = forced_tokens(pattern)
        if not set(tokens or ()) <= set(forced):
            raise ValueError(f"a match of {pattern!r} need not hold all of {tokens}; it must hold {forced}")
        rows.append((len(rows), None, None, None, "block", pattern, forced))
    rules = spark.createDataFrame(rows, "id int, name string, rule_host string, rule_path string, rule_verdict string, pattern string, given array<string>")
    # the last path segment may go on in the url ("/en" fits "/english"), so only segments closed by "/" are tokens
    closed = F.regexp_replace("rule_path", r"[^/]*$", "")
    return rules.withColumn("literals", F.coalesce("given", _tokens(F.col("rule_host"), closed))).drop("given")


_ANY = ""  # stands for a token that every page has


def rule_index(pages: DataFrame, rules: DataFrame, few: bool = True) -> DataFrame:
    """Each rule with the literal token that the fewest pages have; one without
    literals with the token of all pages.  ``few``: the rules may be broadcast."""
    literals = rules.select("id", F.explode("literals").alias("token"))
    seen = pages.select(F.explode("tokens").alias("token"))
    if few:
        seen = seen.join(F.broadcast(literals.select("token").distinct()), "token", "left_semi")
    counts = seen.groupBy("token").agg(F.count("*").alias("n"))
    best = literals.join(counts, "token").groupBy("id").agg(F.min(F.struct("n", "token")).alias("best"))
    found = rules.drop("literals").join(best, "id").withColumn("token", F.col("best.token")).drop("best")
    if not _loose(rules):
        return found
    return found.unionByName(rules.filter(F.size("literals") == 0).drop("literals").withColumn("token", F.lit(_ANY)))


def _loose(rules: DataFrame) -> bool:
    """Whether any rule has no literal token."""
    return rules.filter(F.size("literals") == 0).limit(1).count() > 0


def judge_urls(pages: DataFrame, list_rules=None, pattern_rules=None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule (the deciding list rule), verdict."""
    spark = pages.sparkSession
    list_rules = LIST_RULES if list_rules is None else list_rules
    pattern_rules = PATTERN_RULES if pattern_rules is None else pattern_rules
    rules, few = _rules(spark, list_rules, pattern_rules), len(list_rules) + len(pattern_rules) <= MAX_RULES
    host, path = host_and_path(F.col("url"))
    judged = (
        pages.select(pages[id_col].alias("page_id"), pages[url_col].cast("string").alias("url"))
        .select("page_id", host.alias("host"), path.alias("path"))
        .withColumn("tokens", _tokens(F.col("host"), F.col("path")))
        .withColumn("row_id", F.monotonically_increasing_id())
    )
    index = rule_index(judged, rules, few)
    tokens = F.array_append("tokens", F.lit(_ANY)) if _loose(rules) else F.col("tokens")
    asked = judged.withColumn("token", F.explode_outer(tokens)).drop("tokens")
    if few:
        candidates = asked.join(F.broadcast(index), "token", "left")
    else:
        asked = asked.withColumn("salt", F.pmod(F.xxhash64("row_id"), F.lit(SALTS)).cast("int"))
        salted = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        candidates = asked.join(salted, ["token", "salt"], "left")
    same_host = (F.col("host") == F.col("rule_host")) | F.col("host").endswith(F.concat(F.lit("."), F.col("rule_host")))
    fits = same_host & F.col("path").startswith(F.col("rule_path"))
    matches = F.regexp(F.concat("host", "path"), F.col("pattern"))
    listed = F.struct(F.length("name").alias("size"), F.col("name"), F.col("rule_verdict"))
    verdicts = candidates.groupBy("row_id").agg(
        F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"),
        F.max(F.when(F.col("name").isNotNull() & fits, listed)).alias("listed"),
        F.max(F.when(F.col("pattern").isNotNull(), matches)).alias("pattern_hit"),
    )
    method = F.when(F.coalesce("pattern_hit", F.lit(False)), "block").otherwise("allow")
    return verdicts.select(
        "page_id", "host", "path", F.col("listed.name").alias("rule"), F.coalesce(F.col("listed.rule_verdict"), method).alias("verdict")
    )
