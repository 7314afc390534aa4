"""URL filter by path templates: rules first, then the purity of a url's template.

Only DataFrame functions are used. Per host the paths form a tree of segments:

1. digits and long hex strings inside a segment are generalised by its writing;
2. from the root downwards, the children of a node become one wildcard if there
   are many of them for the rows they hold;
3. a branch whose labelled purity does not differ from its parent's by more
   than ``z`` standard errors is merged into the parent;
4. a url belongs to the deepest unmerged node on its way down, and is blocked
   if that node's purity, smoothed towards the overall purity, is below
   ``min_purity``.

Pages are counted by (host, path) with partial counts before any shuffle, so a
host that holds a third of the pages is a few rows per task; everything after
that works on distinct templates. The verdict comes back by an equi-join, which
adaptive execution broadcasts if the templates are small and splits if a host
is hot. Paths are taken in their whole depth; there are as many steps from level
to level as are shared by more than ``many`` paths of one host.

Special cases: a null url or one without "://" has empty host and path, which
fit no rule and form a template of their own. Repeated rows are judged alike. An
empty table gives no rows. A very long url is judged whole.
Without labels every purity is 1 and nothing is blocked but by rule. The longest
rule wins; of equally long ones the first by code point. Extra columns are
handed through; columns called like an added one are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .words import free_name, lower_ascii, quoted

MANY_CHILDREN = 20  # a node with more children than this ...
ROWS_PER_CHILD = 10  # ... and fewer rows per child than this has a variable segment
Z = 2.0
SMOOTHING = 10.0
MIN_PURITY = 0.5

_ADDED = ["host", "path", "rule", "verdict", "template", "purity"]


def url_host(url: Column) -> Column:
    """After the first "://" up to "/", "?" or "#", A-Z lower-cased; else empty."""
    return lower_ascii(F.regexp_extract(_after(url), r"^([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """What follows the host up to "?" or "#"; else empty."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def matching_rule(host: Column, path: Column, rules: list[str]) -> Column:
    """The longest of ``rules`` (host and start of path, like ``example.net/en/``) that fits."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), [-ord(c) for c in r])):
        name, _, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def segment_shapes(path: Column) -> Column:
    """The segments of a path with digit runs as ``#`` and long hex strings as ``h``."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(
        segments,
        lambda s: F.regexp_replace(
            F.regexp_replace(s, r"(?i)\b[0-9a-f]{8,}\b", "h"), r"[0-9]+", "#"
        ),
    )


def templates(
    counted: DataFrame, many: int = MANY_CHILDREN, per_child: int = ROWS_PER_CHILD
) -> DataFrame:
    """Wildcards for variable segments.

    ``counted``: (host, shapes, n, labelled, good), one row per host and shapes;
    comes back with the array ``template``.
    """
    now = counted.withColumn("template", F.col("shapes"))
    # A segment varies only where more than ``many`` paths of a host go as deep.
    deeper = Window.partitionBy("host").orderBy(F.desc("size"))
    levels = (
        counted.groupBy("host", F.size("shapes").alias("size"))
        .agg(F.count(F.lit(1)).alias("paths"))
        .withColumn("as_deep", F.sum("paths").over(deeper))
        .where(F.col("as_deep") > many)
        .agg(F.max("size"))
        .first()[0]
        or 0
    )
    for level in range(levels):
        above = F.slice("template", 1, level)
        child = F.get("template", level)
        here = now.where(F.size("template") > level).select(
            "host", above.alias("above"), child.alias("child"), "n"
        )
        variable = (
            here.groupBy("host", "above", "child")
            .agg(F.sum("n").alias("n"))
            .groupBy("host", "above")
            .agg(F.count(F.lit(1)).alias("children"), F.sum("n").alias("rows"))
            .where((F.col("children") > many) & (F.col("children") * per_child > F.col("rows")))
            .select(F.col("host").alias("v_host"), F.col("above").alias("v_above"))
        )
        met = now.join(
            variable, (F.col("host") == F.col("v_host")) & (above == F.col("v_above")), "left"
        )
        wild = F.concat(above, F.array(F.lit("*")), F.slice("template", F.lit(level + 2), F.size("template")))
        now = met.withColumn(
            "template",
            F.when(F.col("v_host").isNotNull() & (F.size("template") > level), wild).otherwise(
                F.col("template")
            ),
        ).drop("v_host", "v_above")
        now = stage(now, "templates") if level % 2 else now
    return now


def merged_templates(
    templated: DataFrame,
    z: float = Z,
    smoothing: float = SMOOTHING,
) -> DataFrame:
    """(host, shapes, node, purity): the deepest unmerged node above each path."""
    rows = stage(templated, "templated")
    ways = rows.withColumn(
        "node",
        F.explode(F.transform(F.sequence(F.lit(0), F.size("template")),
                              lambda d: F.slice("template", 1, d))),
    )
    nodes = stage(
        ways.groupBy("host", "node").agg(
            F.sum("labelled").alias("labelled"), F.sum("good").alias("good")
        ),
        "template-nodes",
    )
    overall = nodes.where(F.size("node") == 0).agg(
        F.try_divide(F.sum("good"), F.sum("labelled")).alias("p")
    )
    prior = overall.first()[0]  # one number
    prior = 1.0 if prior is None else float(prior)
    parents = nodes.select(
        F.col("host").alias("p_host"),
        F.col("node").alias("p_node"),
        F.col("labelled").alias("p_labelled"),
        F.col("good").alias("p_good"),
    )
    upper = F.slice("node", 1, F.size("node") - 1)
    is_child = F.size("node") > 0
    p = F.try_divide(F.col("p_good"), F.col("p_labelled"))
    # |good - n p| > z sqrt(n p (1 - p)), squared so that integers and one product decide
    gap = F.col("good") - F.col("labelled") * p
    differs = gap * gap > F.lit(z * z) * F.col("labelled") * p * (F.lit(1.0) - p)
    children = nodes.where(is_child).select("*", upper.alias("upper"))
    apart = (
        children.join(
            parents, (F.col("host") == F.col("p_host")) & (F.col("upper") == F.col("p_node"))
        )
        .where((F.col("labelled") > 0) & differs)
        .select("host", "node")
    )
    purity = (F.col("good") + F.lit(smoothing * prior)) / (F.col("labelled") + F.lit(smoothing))
    apart = apart.select(F.col("host").alias("a_host"), F.col("node").alias("a_node"))
    deepest = (
        ways.select("host", "shapes", "node")
        .join(apart, (F.col("host") == F.col("a_host")) & (F.col("node") == F.col("a_node")), "left")
        .groupBy("host", "shapes")
        .agg(
            F.max_by(
                "node", F.when(F.col("a_host").isNotNull() | (F.size("node") == 0), F.size("node"))
            ).alias("node")
        )
    )
    scored = nodes.select(
        F.col("host").alias("n_host"), F.col("node").alias("n_node"), purity.alias("purity")
    )
    return deepest.join(
        scored, (F.col("host") == F.col("n_host")) & (F.col("node") == F.col("n_node"))
    ).select("host", "shapes", "node", "purity")


def judge_urls(
    pages: DataFrame,
    rules: dict[str, str],
    url_col: str = "url",
    good: Column | None = None,
    min_purity: float = MIN_PURITY,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict``, ``template`` and ``purity``.

    ``rules`` gives ``allow`` or ``block`` for each rule; ``good`` is true, false
    or null (no label) for each row.
    """
    url = quoted(url_col)
    keep = [quoted(c) for c in pages.columns if c.lower() not in _ADDED]
    label = F.lit(None).cast("boolean") if good is None else good
    own = {c: free_name([*pages.columns, *_ADDED], c) for c in ("label", "shapes", "f_host", "f_shapes")}
    work = pages.select(
        *keep, url_host(url).alias("host"), url_path(url).alias("path"), label.alias(own["label"])
    ).withColumn(own["shapes"], segment_shapes(F.col("path")))
    counted = stage(
        work.groupBy("host", F.col(own["shapes"]).alias("shapes")).agg(
            F.count(F.lit(1)).alias("n"),
            F.count(own["label"]).alias("labelled"),
            F.count_if(own["label"]).alias("good"),
        ),
        "url-paths",
    )
    found = stage(merged_templates(templates(counted)), "url-templates").select(
        F.col("host").alias(own["f_host"]),
        F.col("shapes").alias(own["f_shapes"]),
        F.concat(F.col("host"), F.lit("/"), F.array_join("node", "/")).alias("template"),
        "purity",
    )
    rule = matching_rule(F.col("host"), F.col("path"), list(rules))
    by_rule = F.lit(None).cast("string")
    for name, verdict in rules.items():
        by_rule = F.when(F.col("rule") == name, F.lit(verdict)).otherwise(by_rule)
    by_template = F.when(F.col("purity") < min_purity, "block").otherwise("allow")
    return (
        work.join(
            found,
            (F.col("host") == F.col(own["f_host"]))
            & (F.col(own["shapes"]) == F.col(own["f_shapes"])),
        )
        .withColumn("rule", rule)
        .withColumn("verdict", F.coalesce(by_rule, by_template))
        .select(*keep, *_ADDED)
    )
