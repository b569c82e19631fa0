"""URL filter by rules and link-graph propagation, DataFrame functions only.

A rule names a host (with its subdomains) and a path prefix; the longest rule
that fits judges a url. Urls without a fitting rule are judged by their host:
trust starts at hosts whose pages rules allow and follows links; distrust
starts at hosts whose pages rules block and follows links backwards (who links
to bad hosts is suspect). Both are personalised PageRank over host edges,
where a host's seed is the share of its pages that rules allow or block. A
host is blocked when its distrust exceeds its trust by the threshold; with
``(1 - damping) / 2``, a host without links is blocked when blocked pages
outnumber allowed ones by half of its pages.

Defined results: a null url, or one without ``://``, has host and path '' and
is allowed; a null html has no links; repeated rows are pages of their own;
other columns are not used; without links between hosts the seeds decide.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions.joins import hot_split_join
from meridian.llm.common import lower_ascii, ship, staged

# Fixed values: (verdict, rule), a rule being a host and a path
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
DAMPING = 0.85
MARGIN = (1 - DAMPING) / 2
ROUNDS = 30           # scores move by under DAMPING ** ROUNDS after these
TOLERANCE = 1e-9


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits, else null. The
    rules are settings and become part of the plan."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame, host: str = "host", html: str = "html") -> DataFrame:
    """``src``, ``dst``, ``n``: links between different hosts, with their
    number of pages. Links without a host stay on their own."""
    links = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(
        r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""), F.lit(1))
    return (pages.where(F.col(host) != "")
            .select(F.col(host).alias("src"), F.explode(F.array_distinct(F.transform(links, lower_ascii))).alias("dst"))
            .where(F.col("src") != F.col("dst"))
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``host``, ``trust``, ``distrust`` for hosts that have either.

    ``seeds``: ``host``, ``trust``, ``distrust``. Every round is one join of
    the edges with the scores, written to the shared folder."""
    out_n = edges.groupBy("src").agg(F.sum("n").alias("_out"))
    in_n = edges.groupBy("dst").agg(F.sum("n").alias("_in"))
    forward = edges.join(out_n, "src").select(
        F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"),
        (F.col("n") / F.col("_out")).alias("w"))
    backward = edges.join(in_n, "dst").select(
        F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"),
        (F.col("n") / F.col("_in")).alias("w"))
    steps = staged(forward.unionByName(backward), "links")
    start = staged(seeds.select("host", F.expr("stack(2, 'trust', trust, 'distrust', distrust) as (kind, score)"))
                   .where(F.col("score") > 0).withColumn("score", F.col("score") * (1 - damping)), "seeds")
    scores = start
    for _ in range(rounds):
        moved = (steps.join(scores, ["kind", "host"])
                 .select("kind", F.col("to").alias("host"), (F.col("w") * F.col("score") * damping).alias("score")))
        new = staged(start.unionByName(moved).groupBy("kind", "host").agg(F.sum("score").alias("score")), "scores")
        change = (new.join(scores.withColumnRenamed("score", "old"), ["kind", "host"], "left")
                  .agg(F.max(F.abs(F.col("score") - F.coalesce("old", F.lit(0.0)))).alias("d")).collect()[0]["d"])
        scores = new
        if change is None or change < TOLERANCE:
            break
    pick = {k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)).alias(k)
            for k in ("trust", "distrust")}
    return scores.groupBy("host").agg(pick["trust"], pick["distrust"])


def judge(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
          rules: Sequence[tuple[str, str]] = RULES, margin: float = MARGIN) -> DataFrame:
    """Per row of ``pages``: ``_id``, ``host``, ``path``, ``rule``, ``verdict``."""
    at = pages.select(F.col(page_id).alias("_id"), host_of(F.col(url)).alias("host"),
                      path_of(F.col(url)).alias("path"), F.col(html).alias("_html"))
    fit = at.withColumn("_fit", longest_rule(F.col("host"), F.col("path"), rules))
    verdict = F.col("_fit.verdict")
    hosts = staged(fit.where(F.col("host") != "").groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"),
        F.avg(F.when(verdict == "allow", 1.0).otherwise(0.0)).alias("trust"),
        F.avg(F.when(verdict == "block", 1.0).otherwise(0.0)).alias("distrust")), "hosts")
    scores = propagate(hosts, host_edges(at, "host", "_html"))
    bad = (scores.where(F.col("distrust") - F.col("trust") >= margin - TOLERANCE)
           .join(hosts.select("host", "pages"), "host")
           .select("host", "pages", F.lit("block").alias("_method")))
    judged = hot_split_join(fit.drop("_html"), bad, ["host"], weight="pages", how="left")
    return judged.select("_id", "host", "path", F.col("_fit.rule").alias("rule"),
                         F.coalesce(verdict, F.col("_method"), F.lit("allow")).alias("verdict"))


ship(__name__)

ORACLE = r"""
WITH RECURSIVE
u AS (SELECT page_id, coalesce(html, '') AS html, coalesce(url, '') AS url, instr(coalesce(url, ''), '://') AS cut FROM pages),
r AS (SELECT page_id, html, CASE WHEN cut = 0 THEN '' ELSE substr(url, cut + 3) END AS rest FROM u),
p AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
rules(rule, rhost, rpath, verdict) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
         ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
fit AS (
  SELECT p.page_id, p.html, host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM p LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY ALL),
hosts AS (
  SELECT host, avg((verdict IS NOT DISTINCT FROM 'allow')::INT) AS trust, avg((verdict IS NOT DISTINCT FROM 'block')::INT) AS distrust
  FROM fit WHERE host <> '' GROUP BY host),
links AS (
  SELECT DISTINCT page_id, html, host AS src, translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst
  FROM (SELECT page_id, html, host, unnest(regexp_extract_all(html,
    '(?i)\b(?:href|src)\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s<>]+)', 1)) AS l FROM p WHERE host <> '')),
edges AS (SELECT src, dst, count(*) AS n FROM links WHERE src <> dst GROUP BY ALL),
steps AS (
  SELECT 'trust' AS kind, src AS host, dst AS dest, n / sum(n) OVER (PARTITION BY src) AS w FROM edges
  UNION ALL SELECT 'distrust', dst, src, n / sum(n) OVER (PARTITION BY dst) FROM edges),
-- the scores are the sum over walks of every length
walk AS (
  SELECT 0 AS k, 'trust' AS kind, host, trust * 0.15::DOUBLE AS score FROM hosts WHERE trust > 0
  UNION ALL SELECT 0, 'distrust', host, distrust * 0.15::DOUBLE FROM hosts WHERE distrust > 0
  UNION ALL
  SELECT k + 1, kind, dest, sum(score * w * 0.85::DOUBLE) FROM walk JOIN steps USING (kind, host)
  WHERE k < 30 GROUP BY k, kind, dest),
scores AS (
  SELECT host, coalesce(sum(score) FILTER (kind = 'distrust'), 0) - coalesce(sum(score) FILTER (kind = 'trust'), 0) AS margin
  FROM walk GROUP BY host)
SELECT page_id, fit.host, path, rule,
       coalesce(verdict, CASE WHEN margin >= 0.075 - 1e-9 THEN 'block' END, 'allow') AS verdict
FROM fit LEFT JOIN scores ON fit.host = scores.host
"""
