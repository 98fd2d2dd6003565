"""URL filters by a path-template tree.

Paths become templates, host by host and level by level: segments with digits
are number wildcards, levels with many rare values become ``*``, and so do sibling
branches whose labelled share of bad pages does not differ from their parent's;
those that differ are merged into ``*0``, ``*1``, ... by their smoothed share. A template is rejected when its smoothed share of bad pages is high;
templates with little evidence lean on their host and hosts on all pages.

Defined results: a null url, or one without ``://``, has an empty host and path
and its own template; nulls in labels are no evidence; repeated rows count as
often as they occur; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebed.llm.common import cut

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class TreeConfig:
    levels: int = 8  # deeper segments share the template ``**``
    min_values: int = 16  # fewer distinct values at a level stay literal
    rows_per_value: float = 4.0  # a level is variable when its values occur less often on average
    z: float = 1.96  # branches closer than this many standard errors to their parent are merged
    bands: int = 4  # classes of shares in which branches unlike their parent are merged
    strength: float = 20.0  # labelled pages that a parent's share counts for
    reject: float = 0.5  # share of bad pages from which a template is blocked


def host_of(url: Column) -> Column:
    parts = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(parts, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(rules: tuple[Rule, ...]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits ``host`` and ``path``, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def skeleton(path: Column) -> Column:
    """Path with every run of digits as ``0``; what a template looks at."""
    return F.regexp_replace(path, "[0-9]+", "0")


def _share(bad: str, labelled: str, parent: Column, strength: float) -> Column:
    return (F.col(bad) + parent * strength) / (F.col(labelled) + F.lit(strength))


def templates(skeletons: DataFrame, config: TreeConfig = TreeConfig()) -> DataFrame:
    """(host, skeleton, template) for rows (host, skeleton, n, labelled, bad), one per host and skeleton.

    Each level is two combined aggregations and a join over skeletons, of which
    there are far fewer than pages.
    """
    segments = F.filter(F.split("skeleton", "/"), lambda x: x != "")
    state = skeletons.withColumn("segments", segments).withColumn("template", F.lit(""))
    for level in range(config.levels):
        here = F.get("segments", F.lit(level))
        seg = F.when(here.isNull(), F.lit(None)).when(here.contains("0"), F.regexp_replace(here, "0", "{n}")).otherwise(here)
        state = state.withColumn("segment", seg)
        parents = state.where("segment is not null").groupBy("host", "template").agg(
            F.sum("n").alias("p_n"), F.approx_count_distinct("segment", 0.02).alias("p_values"),
            F.sum("labelled").alias("p_labelled"), F.sum("bad").alias("p_bad"))
        children = state.where("segment is not null").groupBy("host", "template", "segment").agg(
            F.sum("labelled").alias("c_labelled"), F.sum("bad").alias("c_bad"))
        rate = F.try_divide(F.col("p_bad"), F.col("p_labelled"))
        error = F.sqrt(F.col("c_labelled") * rate * (1 - rate))
        like = F.coalesce(F.abs(F.try_divide(F.col("c_bad") - F.col("c_labelled") * rate, error)) < config.z, F.lit(True))
        variable = (F.col("p_values") >= config.min_values) & (F.col("p_n") < config.rows_per_value * F.col("p_values"))
        # branches unlike their parent are merged with those of about the same share
        share = _share("c_bad", "c_labelled", rate, config.strength)
        band = F.least(F.floor(share * config.bands), F.lit(config.bands - 1))
        merged = children.join(parents, ["host", "template"]).select(
            "host", "template", "segment",
            F.when(variable | like, F.lit("*")).otherwise(F.concat(F.lit("*"), band.cast("string"))).alias("general"))
        state = cut(
            state.join(merged, ["host", "template", "segment"], "left").withColumn(
                "template", F.concat("template", F.coalesce(F.concat(F.lit("/"), F.col("general")), F.lit("")))
            ).drop("segment", "general"))
        if state.where(F.size("segments") > level + 1).isEmpty():
            break
    deep = F.when(F.size("segments") > config.levels, F.lit("/**")).otherwise("")
    return state.select("host", "skeleton", "n", "labelled", "bad", F.concat("template", deep).alias("template"))


def judge(
    pages: DataFrame, rules: tuple[Rule, ...], labels: DataFrame | None = None, config: TreeConfig = TreeConfig()
) -> DataFrame:
    """(page_id, host, path, rule, template, bad_share, verdict) of every row of ``pages`` (page_id, url).

    ``labels`` (label_id, bad) is evidence for the rows whose ``label_id`` it names, if ``pages`` has
    that column; the rules' verdicts are evidence for none.
    """
    rows = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rows = rows.withColumn("skeleton", skeleton(F.col("path")))
    known = F.lit(None).cast("boolean")
    if labels is not None:
        marks = labels.where("label_id is not null and bad is not null").groupBy("label_id").agg(F.max("bad").alias("bad"))
        rows = rows.join(marks, "label_id", "left")
        known = F.col("bad")
    rows = cut(rows.select("page_id", "host", "path", "skeleton", known.alias("bad")))
    counted = rows.groupBy("host", "skeleton").agg(
        F.count("*").alias("n"), F.count("bad").alias("labelled"), F.count_if("bad").alias("bad"))
    shaped = cut(templates(cut(counted), config))
    overall = shaped.agg(F.sum("bad").alias("b"), F.sum("labelled").alias("l")).first()
    prior = F.lit((overall["b"] or 0) / max(overall["l"] or 0, 1))
    hosts = shaped.groupBy("host").agg(F.sum("labelled").alias("h_labelled"), F.sum("bad").alias("h_bad")).select(
        "host", _share("h_bad", "h_labelled", prior, config.strength).alias("host_share"))
    shares = shaped.groupBy("host", "template").agg(F.sum("labelled").alias("t_labelled"), F.sum("bad").alias("t_bad"))
    shares = shares.join(hosts, "host").select(
        "host", "template", _share("t_bad", "t_labelled", F.col("host_share"), config.strength).alias("bad_share"))
    judged = shaped.select("host", "skeleton", "template").join(shares, ["host", "template"])
    found = rows.join(judged, ["host", "skeleton"]).withColumn("r", rule_of(rules))
    own = F.when(F.col("bad_share") >= config.reject, F.lit("block")).otherwise("allow")
    return found.select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"), "template", "bad_share",
        F.coalesce(F.col("r.verdict"), own).alias("verdict"))
