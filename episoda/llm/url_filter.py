"""URL filter: explicit rules first, then a path-template tree learned per host.

Every path is a branch of its host's tree, one level a segment. Segments that vary by themselves (numbers, dates, hex strings, numbered
files) become wildcards by shape; siblings without labels become one wildcard; and labelled siblings whose block rates do not differ beyond
`z` standard errors from their siblings' pooled rate are merged. Labels are whatever the rules decide.

A template with labels is rejected if its block rate, smoothed by `weight` pseudo-labels at the corpus's rate, reaches `purity`. A template
without labels is judged by the deepest branch above it that has some, on the blocked share of all pages there, those without a label counted
as not blocked; a host without labels by the hosts of its family (the last two names) in the same way. So an unknown branch is rejected only
where nearly everything around it is known to be blocked. Column `decided_by` tells rule, tree (with `labels` and `purity`) or default.

All counting is grouped aggregation over (host, template) counts, which pages are reduced to first; no task gathers a host. The tree is built
level by level, only where two templates still share their path so far: as many rounds as the longest path that two templates share.

Defined results: a null url or one without :// has empty host and path; without labels everything is allowed; rules that fit equally long are
taken by the longer host, then block; rows may repeat; a path of any length is one template; null page ids are kept; empty tables give no rows;
further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episoda.llm import common

Z, WEIGHT, PURITY = 1.96, 4.0, 0.8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Shapes of segments that vary by themselves, and what stands for them.
SHAPES = (
    (r"^\d{4}-\d{2}-\d{2}$", "{date}"),
    (r"^\d+$", "{n}"),
    (r"^\d+(\.[A-Za-z]{1,5})$", "{n}$1"),
    (r"^[0-9a-fA-F]{8,}$", "{hex}"),
    (r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", "{uuid}"),
)


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Index of the longest rule that fits, or null."""
    out = F.lit(None).cast("int")
    for i, r in sorted(enumerate(rules), key=lambda x: (len(x[1].text), len(x[1].host), x[1].verdict == "block")):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(i)).otherwise(out)
    return out


def _shape(segment: Column) -> Column:
    out = segment
    for pattern, name in SHAPES:
        out = F.regexp_replace(out, pattern, name)
    return out


def template_of(path: Column) -> Column:
    """The path's segments, those that vary by their shape's name."""
    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), _shape)


def family_of(host: Column) -> Column:
    """The last two names of a host."""
    return F.regexp_extract(host, r"([^.]*\.)?[^.]*$", 0)


def _merged(at: DataFrame, level: int, z: float) -> DataFrame:
    """Leaves (host, template, node, n, b, m) with the segment at `level` of each node replaced where siblings are merged."""
    at = at.withColumn("parent", F.slice("node", 1, level - 1)).withColumn("segment", F.get("node", F.lit(level - 1)))
    child = common.materialise(at.groupBy("host", "parent", "segment").agg(F.sum("n").alias("n"), F.sum("b").alias("b")), "url-children")
    above = child.groupBy("host", "parent").agg(F.count_if(F.col("n") == 0).alias("unknown"), F.sum("n").alias("pn"), F.sum("b").alias("pb"))
    rest_n, rest_b = F.col("pn") - F.col("n"), F.col("pb") - F.col("b")
    rate = F.try_divide("pb", "pn")
    error = F.sqrt(rate * (1 - rate) * (F.try_divide(F.lit(1.0), F.col("n")) + F.try_divide(F.lit(1.0), rest_n)))
    alike = F.abs(F.try_divide("b", "n") - F.try_divide(rest_b, rest_n)) <= z * error  # null where a side has no labels
    to = F.when((F.col("n") == 0) & (F.col("unknown") > 1), F.lit("*")).when(alike, F.lit("{alike}")).otherwise(F.col("segment"))
    pick = common.materialise(child.join(above, ["host", "parent"]).select("host", "parent", "segment", to.alias("to")), "url-branches")
    node = F.concat("parent", F.array("to"), F.slice("node", level + 1, F.size("node")))
    return at.join(pick, ["host", "parent", "segment"]).select("host", "template", "n", "b", "m", node.alias("node"))


def learn(pages: DataFrame, z: float = Z, weight: float = WEIGHT) -> DataFrame:
    """pages(host, template, block 0/1/null) as (host, template, node, labels, purity): the tree's node for each template, and the evidence that judges it (labels 0: none)."""
    counts = [F.count("block").alias("n"), F.coalesce(F.sum("block"), F.lit(0)).alias("b"), F.count("*").alias("m")]
    active = common.materialise(pages.groupBy("host", "template").agg(*counts).withColumn("node", F.col("template")), "url-leaves")
    level, done = 0, active.where("size(node) = 0").withColumn("shared", F.lit(0))
    while active.where(F.size("node") > level).head(1):
        level += 1
        moved = common.materialise(_merged(active.where(F.size("node") >= level), level, z), "url-leaves")
        prefix = F.slice("node", 1, level)
        several = moved.groupBy("host", prefix.alias("prefix")).agg(F.min("node").alias("x"), F.max("node").alias("y")).select("host", "prefix", (F.col("x") != F.col("y")).alias("goes_on"))
        moved = common.materialise(moved.withColumn("prefix", prefix).join(several, ["host", "prefix"]).drop("prefix"), "url-leaves")
        active = moved.where("goes_on").drop("goes_on")
        done = done.unionByName(moved.where(~F.col("goes_on") | (F.size("node") == level)).drop("goes_on").withColumn("shared", F.lit(level)))
        active = active.where(F.size("node") > level)
    leaves = common.materialise(done, "url-leaves")
    sums = [F.sum(c).alias(c) for c in ("n", "b", "m")]
    nodes = common.materialise(leaves.groupBy("host", "node").agg(*sums, F.max("shared").alias("shared")), "url-nodes")
    # a longer prefix than `shared` belongs to this node alone and says what the node says
    places = F.array_distinct(F.concat(F.sequence(F.lit(0), F.least("shared", F.size("node"))), F.array(F.size("node"))))
    chain = nodes.select("host", "node", F.explode(places).alias("level"), "n", "b", "m").withColumn("prefix", F.slice("node", 1, F.col("level")))
    totals = common.materialise(chain.groupBy("host", "prefix").agg(*sums).where("n > 0"), "url-prefixes")
    known = chain.select("host", "node", "level", "prefix").join(totals, ["host", "prefix"])
    known = known.groupBy("host", "node").agg(F.max(F.struct("level", "n", "b", "m")).alias("own"))
    family = family_of(F.col("host")).alias("family")
    families = common.materialise(nodes.groupBy(family).agg(*sums), "url-families")
    prior = families.agg(F.coalesce(F.try_divide(F.sum("b"), F.sum("n")), F.lit(0.0)).alias("prior"))  # one row
    found = nodes.select("host", "node", family).join(known, ["host", "node"], "left").join(families.withColumnsRenamed({"n": "fn", "b": "fb", "m": "fm"}), "family").crossJoin(F.broadcast(prior))
    here = F.col("own.level") == F.size("node")
    blocked, seen = F.coalesce("own.b", "fb"), F.when(here, F.col("own.n")).otherwise(F.coalesce("own.m", "fm"))
    found = found.select("host", "node", F.coalesce("own.n", "fn").alias("labels"), ((blocked + weight * F.col("prior")) / (seen + weight)).alias("purity"))
    return leaves.select("host", "template", "node").join(found, ["host", "node"])


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, purity: float = PURITY, **tree) -> DataFrame:
    """page_id, host, path, rule, verdict, template (of the tree), labels, purity, decided_by for every row of pages(page_id, url)."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("_template", template_of(F.col("path")))
    rows = common.materialise(rows, "urls")
    said = F.lit(None).cast("string")
    name = F.lit(None).cast("string")
    for i, r in enumerate(rules):
        said, name = F.when(F.col("_rule") == i, F.lit(r.verdict)).otherwise(said), F.when(F.col("_rule") == i, F.lit(r.text)).otherwise(name)
    rows = rows.withColumn("_said", said)
    labelled = rows.select("host", F.col("_template").alias("template"), F.when(F.col("_said") == "block", 1).when(F.col("_said") == "allow", 0).alias("block"))
    learned = common.materialise(learn(labelled, **tree).withColumnsRenamed({"template": "_template"}), "url-templates")
    judged = rows.join(learned, ["host", "_template"], "left")
    verdict = F.coalesce("_said", F.when((F.col("labels") > 0) & (F.col("purity") >= purity), "block").otherwise("allow"))
    by = F.when(F.col("_said").isNotNull(), "rule").when(F.col("labels") > 0, "tree").otherwise("default")
    return judged.select("page_id", "host", "path", name.alias("rule"), verdict.alias("verdict"), F.concat(F.lit("/"), F.array_join("node", "/")).alias("template"), "labels", "purity", by.alias("decided_by"))


def oracle_sql(rules: tuple[Rule, ...] = RULES, depth: int = 6, z: float = Z, weight: float = WEIGHT, purity: float = PURITY) -> str:
    """The same verdicts in DuckDB: page_id, host, path, rule, verdict; for templates that share paths of fewer than `depth` segments."""
    url = "coalesce(url, '')"
    which = "CASE "
    for i, r in sorted(enumerate(rules), key=lambda x: (-len(x[1].text), -len(x[1].host), x[1].verdict != "block")):
        which += f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN {i} "
    which += "END"
    name = "CASE rule_no " + " ".join(f"WHEN {i} THEN '{r.text}'" for i, r in enumerate(rules)) + " END"
    said = "CASE rule_no " + " ".join(f"WHEN {i} THEN '{r.verdict}'" for i, r in enumerate(rules)) + " END"
    shaped = "s"
    for pattern, stands in SHAPES:
        shaped = f"regexp_replace({shaped}, '{pattern}', '{stands.replace('$1', chr(92) + '1')}')"
    parts = [
        f"u AS (SELECT page_id, translate(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host, regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages)",
        f"q AS (SELECT *, {which} AS rule_no, list_filter(string_split(path, '/'), lambda s: s <> '') AS segments FROM u)",
        f"t AS (SELECT *, {said} AS said, {name} AS rule, list_transform(segments, lambda s: {shaped}) AS template FROM q)",
        "l0 AS (SELECT host, template, count(said) AS n, count(*) FILTER (said = 'block') AS b, count(*) AS m, template AS node FROM t GROUP BY 1, 2)",
    ]
    for k in range(1, depth + 1):
        own, rest = f"c{k}.b / nullif(c{k}.n, 0)", f"(pb - c{k}.b) / nullif(pn - c{k}.n, 0)"
        error = f"sqrt(pb / nullif(pn, 0) * (1 - pb / nullif(pn, 0)) * (1 / nullif(c{k}.n, 0) + 1 / nullif(pn - c{k}.n, 0)))"
        becomes = f"CASE WHEN c{k}.n = 0 AND unknown > 1 THEN '*' WHEN abs({own} - {rest}) <= {z} * {error} THEN '{{alike}}' ELSE c{k}.segment END"
        parts += [
            f"c{k} AS (SELECT host, node[1:{k - 1}] AS parent, node[{k}] AS segment, sum(n) AS n, sum(b) AS b FROM l{k - 1} WHERE len(node) >= {k} GROUP BY 1, 2, 3)",
            f"p{k} AS (SELECT host, parent, count(*) FILTER (n = 0) AS unknown, sum(n) AS pn, sum(b) AS pb FROM c{k} GROUP BY 1, 2)",
            f"d{k} AS (SELECT c{k}.host, c{k}.parent, c{k}.segment, {becomes} AS becomes FROM c{k} JOIN p{k} ON c{k}.host = p{k}.host AND c{k}.parent = p{k}.parent)",
            f"l{k} AS (SELECT l.host, template, n, b, m, CASE WHEN becomes IS NULL THEN node ELSE list_concat(parent, [becomes], node[{k + 1}:]) END AS node FROM l{k - 1} l LEFT JOIN d{k} d ON l.host = d.host AND l.node[1:{k - 1}] = d.parent AND l.node[{k}] = d.segment)",
        ]
    parts += [
        f"nodes AS (SELECT host, node, sum(n) AS n, sum(b) AS b, sum(m) AS m, regexp_extract(host, '([^.]*\\.)?[^.]*$') AS family FROM l{depth} GROUP BY 1, 2)",
        "chain AS (SELECT host, node, n, b, m, unnest(range(0, len(node) + 1)) AS level FROM nodes)",
        "totals AS (SELECT host, node[1:level] AS prefix, sum(n) AS n, sum(b) AS b, sum(m) AS m FROM chain GROUP BY 1, 2)",
        "known AS (SELECT c.host, c.node, arg_max({'level': level, 'n': t.n, 'b': t.b, 'm': t.m}, level) AS own FROM chain c JOIN totals t ON c.host = t.host AND c.node[1:c.level] = t.prefix WHERE t.n > 0 GROUP BY 1, 2)",
        "families AS (SELECT family, sum(n) AS n, sum(b) AS b, sum(m) AS m FROM nodes GROUP BY 1)",
        "prior AS (SELECT coalesce(sum(b) / nullif(sum(n), 0), 0) AS prior FROM nodes)",
        f"found AS (SELECT x.host, x.node, coalesce(own.n, f.n) AS labels, (coalesce(own.b, f.b) + {weight} * prior) / (CASE WHEN own.level = len(x.node) THEN own.n ELSE coalesce(own.m, f.m) END + {weight}) AS purity FROM nodes x JOIN families f ON x.family = f.family LEFT JOIN known k ON x.host = k.host AND x.node = k.node, prior)",
        f"judged AS (SELECT l.host, template, labels, purity FROM l{depth} l JOIN found ON l.host = found.host AND l.node = found.node)",
    ]
    with_all = ",\n".join(parts)
    return f"WITH {with_all}\nSELECT page_id, t.host, path, rule, coalesce(said, CASE WHEN labels > 0 AND purity >= {purity} THEN 'block' ELSE 'allow' END) AS verdict FROM t LEFT JOIN judged j ON t.host = j.host AND t.template = j.template"
