"""Operator 4: urls judged by rules, and by trust and distrust that spread over links of hosts.

Rules decide first. For all other urls the host decides: personalised PageRank carries trust from
the hosts of allowed pages along links, and distrust from the hosts of blocked pages against them
(a host that links to a blocked one is suspect). Seeds weigh as many pages as the rules judged. A
host is blocked if its distrust exceeds ``threshold`` times its trust.

Links are the ``href`` targets of the pages; a link without a host stays on its own host. They are
summed per pair of hosts before they are shuffled, so that a host with a third of all pages sends
one row per task and target. The rank tables are joined and summed in Spark, round by round, and
written to the shared folder after each; only sums of all hosts reach the driver. Rounds end when
the ranks move by less than ``tolerance`` in all, some 90 rounds at the most with this damping, or
after ``rounds`` if the caller sets them.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no rule and is
allowed. Null html has no links. Hosts that neither seed reaches are allowed. Rows are judged one
by one, so repeated rows and null ids are kept. An empty table gives an empty table.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.sources.tables import stage

# (host, path, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
DAMPING = 0.85
THRESHOLD = 1.0
# ranks that have not settled by then never will
GUARD = 1000
TOLERANCE = 1e-6

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HREF = r"(?i)\bhref\s*=\s*[\"']?([^\"'>\s]+)"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://(?s:(.*))$", 1), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """``(rule, verdict)`` of the longest rule that fits, else nulls."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_links(pages: DataFrame) -> DataFrame:
    """``(a, b, n)``: links from host to host and their number."""
    own = host_of(F.col("url"))
    target = F.when(F.col("link").startswith("//"), F.concat(F.lit("x:"), F.col("link"))).otherwise(F.col("link"))
    return (
        pages.select(own.alias("a"), F.explode(F.regexp_extract_all("html", F.lit(_HREF))).alias("link"))
        .select("a", F.when(host_of(target) == "", F.col("a")).otherwise(host_of(target)).alias("b"))
        .where("a != '' AND b != ''")
        .groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    )


def ranks(
    links: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int | None = None, tolerance: float = TOLERANCE,
) -> DataFrame:
    """``(host, trust, distrust)`` from links ``(a, b, n)`` and seeds ``(host, good, bad)``.

    Rank that reaches a host without links returns to the seeds.
    """
    out_of = links.groupBy(F.col("a").alias("_a")).agg(F.sum("n").alias("_out"))
    into = links.groupBy(F.col("b").alias("_b")).agg(F.sum("n").alias("_in"))
    links = stage(
        links.join(out_of, F.col("a") == F.col("_a")).join(into, F.col("b") == F.col("_b")).select(
            "a", "b", (F.col("n") / F.col("_out")).alias("down"), (F.col("n") / F.col("_in")).alias("up")
        ),
        "links",
    )
    hosts = links.select(F.col("a").alias("host")).union(links.select("b")).union(seeds.select("host")).distinct()
    good, bad = seeds.agg(F.sum("good"), F.sum("bad")).first()
    start = hosts.join(seeds, "host", "left").select(
        "host",
        (F.coalesce("good", F.lit(0)) / F.lit(float(good or 1))).alias("good"),
        (F.coalesce("bad", F.lit(0)) / F.lit(float(bad or 1))).alias("bad"),
    )
    now = stage(start.withColumns({"trust": F.col("good"), "distrust": F.col("bad")}), "ranks")
    for turn in itertools.count(1):
        if rounds is not None and turn > rounds:
            break
        if turn > GUARD:
            raise RuntimeError(f"ranks still move after {GUARD} rounds; is the damping below 1?")
        ahead = links.join(now.select(F.col("host").alias("a"), "trust"), "a").select(
            F.col("b").alias("_host"), (F.col("trust") * F.col("down")).alias("t"), F.lit(0.0).alias("d")
        )
        back = links.join(now.select(F.col("host").alias("b"), "distrust"), "b").select(
            F.col("a").alias("_host"), F.lit(0.0).alias("t"), (F.col("distrust") * F.col("up")).alias("d")
        )
        got = stage(ahead.union(back).groupBy("_host").agg(F.sum("t").alias("t"), F.sum("d").alias("d")), "sent")
        kept_t, kept_d = got.agg(F.sum("t"), F.sum("d")).first()
        lost_t = max(0.0, 1 - (kept_t or 0.0)) if good else 0.0
        lost_d = max(0.0, 1 - (kept_d or 0.0)) if bad else 0.0
        rank = lambda sent, lost, seed: damping * (F.coalesce(sent, F.lit(0.0)) + lost * F.col(seed)) + (1 - damping) * F.col(seed)
        step = now.join(got, F.col("host") == F.col("_host"), "left")
        moved = stage(
            step.select(
                "host", "good", "bad", rank("t", lost_t, "good").alias("trust"), rank("d", lost_d, "bad").alias("distrust"),
                F.col("trust").alias("_t"), F.col("distrust").alias("_d"),
            ),
            "ranks",
        )
        change = moved.agg(F.sum(F.abs(F.col("trust") - F.col("_t")) + F.abs(F.col("distrust") - F.col("_d")))).first()[0]
        now = moved.select("host", "good", "bad", "trust", "distrust")
        if not change or change < tolerance:
            break
    return now.select("host", "trust", "distrust")


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, threshold: float = THRESHOLD, **settings
) -> DataFrame:
    """``(page_id, host, path, rule, verdict, trust, distrust)`` for every page."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"), rule_of(host, path, rules).alias("_rule"))
    counts = (
        judged.where("host != '' AND _rule IS NOT NULL").groupBy("host")
        .agg(F.count_if(F.col("_rule.verdict") == "allow").alias("good"), F.count_if(F.col("_rule.verdict") == "block").alias("bad"))
    )
    scored = ranks(host_links(pages), stage(counts, "seeds"), **settings).withColumnRenamed("host", "_host")
    by_host = F.when(F.col("distrust") > threshold * F.col("trust"), "block").otherwise("allow")
    return judged.join(scored, F.col("host") == F.col("_host"), "left").select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), by_host).alias("verdict"), "trust", "distrust",
    )
