"""URL verdicts: rules of hosts and paths first, then a tree of path templates for each host.

A segment that few URLs of its branch share becomes a wildcard of its shape; a common one
whose share of good labels and of ending URLs is like that of its siblings is merged with
them. Templates whose smoothed share of good labels is low are blocked. All of it is
joins and aggregates.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.tables import staged

#: Segments of the tree in the SQL, where what lies deeper shares one token; here it has no end.
DEPTH = 3
#: A segment stays as it is with this many URLs and this share of its branch.
SUPPORT, SHARE = 10, 0.05
#: Two shares differ if they are more standard errors apart.
ERRORS = 2.0
#: URLs that the share of the host, and of all hosts, counts for; least share of good ones.
PRIOR, LEAST = 4.0, 0.5


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


# The rules of the query.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty for null or without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(text, _PARTS, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(text, _PARTS, 2)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits as a struct (rule, verdict), else null."""
    chosen = F.when(F.lit(False), F.struct(F.lit("").alias("rule"), F.lit("").alias("verdict")))
    for rule in sorted(rules, key=lambda r: -len(r.host + r.path)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        chosen = chosen.when(fits, F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict")))
    return chosen


def _shape(segment: Column) -> Column:
    """Digits as ``0``, other runs between marks as ``a``."""
    return F.regexp_replace(F.regexp_replace(segment, "[0-9]+", "0"), "[^0._~-]+", "a")


def _differ(part: str, size: str, every: str, of: str) -> Column:
    """Whether a branch's share ``part``/``size`` is unlike that of all its siblings."""
    rest, n = F.col(every) - F.col(part), F.col(of) - F.col(size)
    pooled = F.col(every) / F.col(of)
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.col(size) + 1 / n))
    apart = F.abs(F.col(part) / F.col(size) - rest / n)
    return F.when((F.col(size) > 0) & (n > 0), apart > ERRORS * error).otherwise(False)


def _level(rows: DataFrame, at: int) -> DataFrame:
    """``rows`` with the token of segment ``at`` appended to ``template``."""
    rows = rows.withColumn("_segment", F.get("_segments", F.lit(at)))
    ends = (F.size("_segments") == at + 1).cast("long")
    branches = (
        rows.where("_segment is not null")
        .groupBy("host", "template", "_segment")
        .agg(
            F.count("*").alias("_n"),
            F.count("_good").alias("_m"),
            F.coalesce(F.sum("_good"), F.lit(0)).alias("_g"),
            F.sum(ends).alias("_e"),
        )
    )
    whole = branches.groupBy("host", "template").agg(*(F.sum(f"_{x}").alias(f"_all_{x}") for x in "nmge"))
    common = (F.col("_n") >= SUPPORT) & (F.col("_n") >= SHARE * F.col("_all_n"))
    unlike = _differ("_g", "_m", "_all_g", "_all_m") | _differ("_e", "_n", "_all_e", "_all_n")
    # a branch of its own stands beside nothing it could be merged with
    alone = F.col("_n") == F.col("_all_n")
    token = F.when(common & (unlike | alone), F.col("_segment")).when(common, F.lit("*")).otherwise(_shape(F.col("_segment")))
    tokens = branches.join(whole, ["host", "template"]).select("host", "template", "_segment", token.alias("_token"))
    return (
        rows.join(tokens, ["host", "template", "_segment"], "left")
        .withColumn("template", F.concat("template", F.coalesce(F.concat(F.lit("/"), "_token"), F.lit(""))))
        .drop("_token", "_segment")
    )


def judge_urls(
    df: DataFrame,
    labels: DataFrame,
    rules: Sequence[Rule] = RULES,
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule``, ``verdict``, ``template``, ``n_labelled``, ``n_good``.

    ``labels`` has ``key`` and ``good`` (0 or 1, null: none); of several for a key the worst
    counts. A URL without a label nearby is judged by its host's labels and then by all. A
    null URL or one without ``://`` has an empty host and path and is judged by the template
    of those. Repeated rows are judged alike and count as often as they stand there; other
    columns are not read.
    """
    host, path = url_parts(df[url])
    known = labels.where("good is not null").groupBy(labels[key]).agg(F.min("good").cast("long").alias("_good"))
    rows = (
        df.select(df[key], host.alias("host"), path.alias("path"))
        .join(known, key, "left")
        .withColumn("_segments", F.filter(F.split("path", "/"), lambda s: s != ""))
        .withColumn("template", F.lit(""))
    )
    deepest = rows.agg(F.max(F.size("_segments"))).first()[0] or 0
    done = []
    for at in range(deepest):
        rows = staged(_level(rows, at), f"url-level-{at + 1}")
        if at + 1 == deepest:
            break
        # no segment below a branch of few URLs can be common, so all of them become shapes
        more = F.size("_segments") > at + 1
        large = rows.where(more).groupBy("host", "template").agg(F.count("*").alias("_below")).where(F.col("_below") >= SUPPORT)
        split = staged(rows.join(large, ["host", "template"], "left"), f"url-branches-{at + 1}")
        goes_on = more & F.col("_below").isNotNull()
        rest = F.slice("_segments", at + 2, F.greatest(F.size("_segments") - (at + 1), F.lit(0)))
        shapes = F.array_join(F.transform(rest, lambda s: F.concat(F.lit("/"), _shape(s))), "")
        done.append(split.where(~goes_on).withColumn("template", F.concat("template", shapes)).drop("_below"))
        rows = split.where(goes_on).drop("_below")
        if rows.isEmpty():
            break
    for part in done:
        rows = rows.unionByName(part)
    counts = rows.groupBy("host", "template").agg(F.count("_good").alias("n_labelled"), F.coalesce(F.sum("_good"), F.lit(0)).alias("n_good"))
    counts = staged(counts, "url-templates")
    hosts = counts.groupBy("host").agg(F.sum("n_labelled").alias("_m"), F.sum("n_good").alias("_g"))
    every = counts.agg(F.sum("n_labelled").alias("m"), F.sum("n_good").alias("g")).first()
    overall = every.g / every.m if every.m else 1.0
    host_share = (F.col("_g") + PRIOR * F.lit(overall)) / (F.col("_m") + PRIOR)
    share = (F.col("n_good") + PRIOR * host_share) / (F.col("n_labelled") + PRIOR)
    judged = counts.join(hosts, "host").select(
        "host",
        "template",
        "n_labelled",
        "n_good",
        F.when(share < LEAST, "block").otherwise("allow").alias("_verdict"),
    )
    ruled = matching_rule(F.col("host"), F.col("path"), rules)
    return (
        rows.join(judged, ["host", "template"])
        .withColumn("_rule", ruled)
        .select(
            key,
            "host",
            "path",
            F.col("_rule.rule").alias("rule"),
            F.coalesce("_rule.verdict", "_verdict").alias("verdict"),
            "template",
            "n_labelled",
            "n_good",
        )
    )


def labels_of_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``page_id`` and ``good`` from the label of the document that a URL's path names by number."""
    number = F.regexp_extract(url_parts(F.col("url"))[1], r"/([0-9]{1,18})(?:\.[a-z]+)?/?$", 1)
    named = pages.select("page_id", F.when(number != "", number.cast("long")).alias("doc_id")).where("doc_id is not null")
    judged = labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("good"))
    return named.join(judged, "doc_id").select("page_id", "good")


def _level_sql(at: int) -> str:
    before, now = f"level{at}", f"level{at + 1}"

    def differ(part: str, size: str) -> str:
        pooled = f"(a{part}::DOUBLE / a{size})"
        rest = f"(a{size} - {size})"
        return (
            f"({size} > 0 AND {rest} > 0 AND abs({part}::DOUBLE / {size} - (a{part} - {part})::DOUBLE / {rest}) > "
            f"{ERRORS} * sqrt({pooled} * (1 - {pooled}) * (1.0::DOUBLE / {size} + 1.0::DOUBLE / {rest})))"
        )

    shape = "regexp_replace(regexp_replace(segment, '[0-9]+', '0', 'g'), '[^0._~-]+', 'a', 'g')"
    return f"""
segment{at} AS (SELECT *, segments[{at + 1}] AS segment FROM {before}),
branch{at} AS (
  SELECT host, template, segment, count(*) AS n, count(good) AS m, coalesce(sum(good), 0) AS g,
         sum(CASE WHEN len(segments) = {at + 1} THEN 1 ELSE 0 END) AS e
  FROM segment{at} WHERE segment IS NOT NULL GROUP BY ALL),
whole{at} AS (
  SELECT host, template, sum(n) AS an, sum(m) AS am, sum(g) AS ag, sum(e) AS ae FROM branch{at} GROUP BY ALL),
token{at} AS (
  SELECT host, template, segment,
         CASE WHEN n >= {SUPPORT} AND n >= {SHARE}::DOUBLE * an AND ({differ("g", "m")} OR {differ("e", "n")} OR n = an) THEN segment
              WHEN n >= {SUPPORT} AND n >= {SHARE}::DOUBLE * an THEN '*' ELSE {shape} END AS token
  FROM branch{at} JOIN whole{at} USING (host, template)),
{now} AS (
  SELECT s.page_id, s.host, s.path, s.good, s.segments, s.template || coalesce('/' || t.token, '') AS template
  FROM segment{at} s LEFT JOIN token{at} t
    ON s.host = t.host AND s.template = t.template AND s.segment = t.segment)"""


def oracle() -> str:
    """The query on ``pages`` as DuckDB SQL."""
    ordered = sorted(RULES, key=lambda r: -len(r.host + r.path))

    def choose(give) -> str:
        cases = "".join(
            f" WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{give(r)}'"
            for r in ordered
        )
        return f"CASE{cases} END"

    levels = ",".join(_level_sql(at) for at in range(DEPTH))
    return f"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{_PARTS}', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
         regexp_extract(coalesce(url, ''), '{_PARTS}', 2) AS path
  FROM pages),
judged AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
known AS (
  SELECT page_id, min(good) AS good
  FROM (SELECT page_id, try_cast(nullif(regexp_extract(path, '/([0-9]{{1,18}})(?:\\.[a-z]+)?/?$', 1), '') AS BIGINT) AS doc_id FROM parts)
  JOIN judged USING (doc_id) GROUP BY page_id),
level0 AS (
  SELECT page_id, host, path, good, list_filter(string_split(path, '/'), lambda s: s <> '') AS segments, '' AS template
  FROM parts LEFT JOIN known USING (page_id)),
{levels},
done AS (
  SELECT * REPLACE (template || CASE WHEN len(segments) > {DEPTH} THEN '/**' ELSE '' END AS template) FROM level{DEPTH}),
counts AS (SELECT host, template, count(good) AS n_labelled, coalesce(sum(good), 0)::BIGINT AS n_good FROM done GROUP BY ALL),
hosts AS (SELECT host, sum(n_labelled) AS m, sum(n_good) AS g FROM counts GROUP BY host),
every AS (SELECT CASE WHEN sum(n_labelled) > 0 THEN sum(n_good)::DOUBLE / sum(n_labelled) ELSE 1.0::DOUBLE END AS overall FROM counts),
verdicts AS (
  SELECT host, template, n_labelled, n_good,
         CASE WHEN (n_good + {PRIOR}::DOUBLE * ((g + {PRIOR}::DOUBLE * overall) / (m + {PRIOR}::DOUBLE))) / (n_labelled + {PRIOR}::DOUBLE) < {LEAST}
              THEN 'block' ELSE 'allow' END AS own
  FROM counts JOIN hosts USING (host) CROSS JOIN every)
SELECT page_id, host, path, {choose(lambda r: r.host + r.path)} AS rule,
       coalesce({choose(lambda r: r.verdict)}, own) AS verdict, template, n_labelled, n_good
FROM done JOIN verdicts USING (host, template)"""
