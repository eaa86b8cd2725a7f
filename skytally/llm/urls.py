"""URL filters: host and path rules, then a path-template tree for the urls no rule decides.

Per host, paths become templates: a segment that is a number, a long hex string or a UUID is a
wildcard, and so is every child of a node with more than ``MAX_BRANCHES`` different children.
Sibling branches whose labelled block rate does not differ from that of their siblings together are
merged. A template is rejected when enough of its labelled urls are blocked: the share is smoothed
towards its host's share, which is smoothed towards the share of all urls. The urls that a rule
decides are the labelled ones.

Only counts per distinct path shape are shuffled for the tree; a hot host or template is summed on
the map side, and the join that carries verdicts back to the urls is a plain equi-join that
adaptive execution can split.

Cases: a null url or one without ``://`` has an empty host and path, fits no rule and is allowed;
an empty path has no segments; repeated urls count once each; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skytally.llm.registry import read, register
from skytally.operators.joins import with_computed

# Fixed values: (host, path, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VARIABLE = "^([0-9]+|[0-9a-f]{8,}|[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12})([.][A-Za-z0-9]{1,5})?$"
MAX_BRANCHES = 20
MERGE_Z = 1.96
STRENGTH = 4.0
MIN_LABELLED = 5
MIN_PURITY = 0.8
WILDCARD, MERGED = "*", "~"


def host_and_path(url: Column) -> tuple[Column, Column]:
    found = F.instr(url, "://") > 0
    after = F.regexp_replace(url, "(?s)^.*?://", "")
    host = F.when(found, F.translate(F.regexp_extract(after, "^[^/?#]*", 0), UPPER, LOWER))
    path = F.when(found, F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1))
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _deciding_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else nulls."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, what in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, what).otherwise(verdict)
    return name, verdict


def _joined(parts: Column) -> Column:
    return F.concat(F.lit("/"), F.array_join(parts, "/"))


def template_verdicts(shapes: DataFrame) -> DataFrame:
    """host, shape (array) and rejected of each distinct path shape.

    ``shapes`` has host, shape, labelled and blocked.
    """
    steps = shapes.select(
        "host", "shape", "labelled", "blocked", F.posexplode("shape").alias("depth", "part")
    ).withColumn("parent", _joined(F.slice("shape", 1, F.col("depth"))))
    children = steps.groupBy("host", "depth", "parent", "part").agg(F.lit(1).alias("one"))
    wide = children.groupBy("host", "depth", "parent").agg(
        (F.count("one") > MAX_BRANCHES).alias("wide"))
    # Templates: the shape with the children of wide nodes as wildcards too.
    templates = (
        steps.join(wide, ["host", "depth", "parent"])
        .withColumn("part", F.when(F.col("wide"), WILDCARD).otherwise(F.col("part")))
        .groupBy("host", "shape")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("depth", "part"))), lambda x: x["part"])
             .alias("template"),
             F.first("labelled").alias("labelled"), F.first("blocked").alias("blocked"))
    )
    # Branches of the tree and their labelled counts; siblings are at most MAX_BRANCHES and a wildcard.
    nodes = templates.select(
        "host", "labelled", "blocked", F.posexplode("template").alias("depth", "part"), "template"
    ).select(
        "host", "depth", _joined(F.slice("template", 1, F.col("depth"))).alias("parent"), "part",
        "labelled", "blocked",
    ).groupBy("host", "depth", "parent", "part").agg(
        F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    siblings = Window.partitionBy("host", "depth", "parent")
    rate = F.try_divide(F.sum("blocked").over(siblings), F.sum("labelled").over(siblings))
    nodes = nodes.withColumn("rate", rate)
    gap = F.abs(F.col("blocked") - F.col("labelled") * F.col("rate"))
    spread = MERGE_Z * F.sqrt(F.col("labelled") * F.col("rate") * (1 - F.col("rate")))
    nodes = nodes.select(
        "host", "depth", "parent", "part",
        ((F.col("labelled") >= MIN_LABELLED) & (gap <= spread + 1e-9)).alias("similar"))
    merged = (
        templates.select("host", "shape", "template", "labelled", "blocked",
                         F.posexplode("template").alias("depth", "part"))
        .withColumn("parent", _joined(F.slice("template", 1, F.col("depth"))))
        .join(nodes, ["host", "depth", "parent", "part"])
        .groupBy("host", "shape")
        .agg(_joined(F.transform(
                F.sort_array(F.collect_list(F.struct(
                    "depth", F.when(F.col("similar"), MERGED).otherwise(F.col("part")).alias("part")))),
                lambda x: x["part"])).alias("branch"),
             F.first("labelled").alias("labelled"), F.first("blocked").alias("blocked"))
    )
    sums = [F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")]
    branches = merged.groupBy("host", "branch").agg(*sums)
    hosts = shapes.groupBy("host").agg(
        F.sum("labelled").alias("host_labelled"), F.sum("blocked").alias("host_blocked"))
    overall = shapes.agg(F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked"))
    share = F.coalesce(F.try_divide("all_blocked", "all_labelled"), F.lit(0.0))
    host_share = (F.col("host_blocked") + STRENGTH * share) / (F.col("host_labelled") + STRENGTH)
    purity = (F.col("blocked") + STRENGTH * host_share) / (F.col("labelled") + STRENGTH)
    rejected = (F.col("labelled") >= MIN_LABELLED) & (purity >= MIN_PURITY)
    branches = (branches.join(hosts, "host")
                .withColumn("all_labelled", overall.select("all_labelled").scalar())
                .withColumn("all_blocked", overall.select("all_blocked").scalar())
                .select("host", "branch", rejected.alias("rejected")))
    return merged.select("host", "shape", "branch").join(branches, ["host", "branch"]).select(
        "host", "shape", "rejected")


def filter_urls(pages: DataFrame, key: str = "page_id", url: str = "url", rules=RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of each url."""
    host, path = host_and_path(F.col(f"`{url}`"))
    rows = with_computed(pages.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").alias("url")),
                         {"host": host, "path": path})
    rule, ruled = _deciding_rule(F.col("host"), F.col("path"), rules)
    parts = F.filter(F.split("path", "/"), lambda part: part != "")
    shape = F.transform(parts, lambda part: F.when(part.rlike(VARIABLE), WILDCARD).otherwise(part))
    rows = with_computed(rows.drop("url"), {"rule": rule, "ruled": ruled, "shape": shape})
    shapes = rows.groupBy("host", "shape").agg(
        F.count("ruled").alias("labelled"), F.count_if(F.col("ruled") == "block").alias("blocked"))
    verdicts = template_verdicts(shapes)
    return rows.join(verdicts, ["host", "shape"], "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("rejected"), "block"), F.lit("allow")).alias("verdict"))


def _sql() -> str:
    ordered = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    fits = {r: f"(host = '{r[0]}' OR ends_with(host, '.{r[0]}')) AND starts_with(path, '{r[1]}')" for r in ordered}
    rule = "CASE " + " ".join(f"WHEN {fits[r]} THEN '{r[0]}{r[1]}'" for r in ordered) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits[r]} THEN '{r[2]}'" for r in ordered) + " END"
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS u FROM pages),
located AS (
  SELECT page_id, translate(regexp_extract(u, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(u, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (
  SELECT *, {rule} AS rule, {verdict} AS ruled,
    list_transform(list_filter(string_split(path, '/'), lambda p: p <> ''),
      lambda p: CASE WHEN regexp_matches(p, '{VARIABLE}') THEN '{WILDCARD}' ELSE p END) AS shape
  FROM located),
shapes AS (
  SELECT host, shape, count(ruled) AS labelled, count(*) FILTER (ruled = 'block') AS blocked FROM ruled GROUP BY ALL),
steps AS (
  SELECT *, shape[d + 1] AS part, '/' || array_to_string(shape[1:d], '/') AS parent
  FROM (SELECT *, unnest(range(len(shape))) AS d FROM shapes)),
wide AS (SELECT host, d, parent, count(DISTINCT part) > {MAX_BRANCHES} AS wide FROM steps GROUP BY ALL),
templates AS (
  SELECT host, shape, any_value(labelled) AS labelled, any_value(blocked) AS blocked,
         list(CASE WHEN wide THEN '{WILDCARD}' ELSE part END ORDER BY d) AS template
  FROM steps JOIN wide USING (host, d, parent) GROUP BY host, shape),
branches AS (
  SELECT *, template[d + 1] AS part, '/' || array_to_string(template[1:d], '/') AS parent
  FROM (SELECT *, unnest(range(len(template))) AS d FROM templates)),
nodes AS (
  SELECT host, d, parent, part, sum(labelled) AS labelled, sum(blocked) AS blocked FROM branches GROUP BY ALL),
rated AS (
  SELECT *, CASE WHEN sum(labelled) OVER w > 0 THEN sum(blocked) OVER w / sum(labelled) OVER w END AS rate
  FROM nodes WINDOW w AS (PARTITION BY host, d, parent)),
alike AS (
  SELECT host, d, parent, part, labelled >= {MIN_LABELLED} AND
         abs(blocked - labelled * rate) <= {MERGE_Z} * sqrt(labelled * rate * (1 - rate)) + 1e-9 AS same FROM rated),
merged AS (
  SELECT host, shape, any_value(labelled) AS labelled, any_value(blocked) AS blocked,
         array_to_string(list(CASE WHEN same THEN '{MERGED}' ELSE part END ORDER BY d), '/') AS branch
  FROM branches JOIN alike USING (host, d, parent, part) GROUP BY host, shape),
hosts AS (SELECT host, sum(labelled) AS hl, sum(blocked) AS hb FROM shapes GROUP BY host),
overall AS (SELECT coalesce(sum(blocked) / nullif(sum(labelled), 0), 0) AS share FROM shapes),
purity AS (
  SELECT host, branch, sum(labelled) AS l,
         (sum(blocked) + {STRENGTH} * any_value((hb + {STRENGTH} * share) / (hl + {STRENGTH}))) / (sum(labelled) + {STRENGTH}) AS purity
  FROM merged JOIN hosts USING (host), overall GROUP BY host, branch)
SELECT page_id, r.host, path, rule,
       coalesce(ruled, CASE WHEN l >= {MIN_LABELLED} AND purity >= {MIN_PURITY} THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled r LEFT JOIN merged m ON r.host = m.host AND r.shape = m.shape
LEFT JOIN purity p ON m.host = p.host AND m.branch = p.branch"""


@register("op9_url_templates", _sql())
def op9_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages"))
