"""URL filter: explicit rules first, then path templates judged by the labels that the rules give.

A rule is a host and a path; it fits the host and its subdomains where the path starts with the rule's, and the
longest fitting rule decides. All other urls are judged by templates. Paths become trees of segments per host:

1. Segments that look like identifiers become ``*`` (an extension stays); urls are then counted per shape.
2. From the root down, a node with more than ``MAX_CHILDREN`` branches turns the small ones into ``*``, and
   branches whose share of blocked labels can't be told from their siblings' (a test of proportions) are merged into ``~``.
3. A template is rejected when its smoothed share of blocked labels, pulled to the share of all labels by ``WEIGHT``
   labels, reaches ``REJECT``. A template without labels takes the labels of the nearest node that has some: its parents
   in the tree, the host, then the host's parent domains of two names at least. With none at any level it is kept.

``back_off=False`` leaves out the search for nearest labels: all templates without labels then follow the share of all labels.

DataFrame functions only. Urls are counted per shape before anything else moves, so a host with a third of all
rows is a few rows; its urls meet their templates in ``SALTS`` parts. The tree is walked until no node has two branches
below it; with a ``depth``, segments below count as one. The SQL has to spell levels out and has ``SQL_LEVELS`` of them, which is more than
the given tables have segments; the query itself has no such bound.

Defined results: a null url, or one without ``://``, has an empty host and path, and no rule fits an empty host; an
empty path has the template of its host alone; the rows of repeated urls are all judged.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaftext.llm.common import materialise, table

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
SQL_LEVELS = 8
MAX_CHILDREN = 50
MIN_LABELS = 5
Z = 1.96
WEIGHT = 4.0
REJECT = 0.5
SALTS = 16
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
IDENTIFIER = r"^([0-9]+|[0-9a-fA-F-]*[0-9][0-9a-fA-F-]*)(\.[A-Za-z0-9]{1,5})?$"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)://([^/?#]*)", 1), F.lit("")), UPPER, SMALL)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest fitting rule; null when none fits."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        text, verdict = F.when(fits, h + p).otherwise(text), F.when(fits, what).otherwise(verdict)
    return text, verdict


def shape_of(path: Column, depth: int | None) -> Column:
    """The segments of a path, identifiers as ``*``; with a depth the first of them, and one more for the rest."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    general = F.transform(segments if depth is None else F.slice(segments, 1, depth), lambda s: F.regexp_replace(s, IDENTIFIER, "*$2"))
    if depth is None:
        return general
    return F.when(F.size(segments) > depth, F.array_append(general, F.lit("**"))).otherwise(general)


def _open(tree: DataFrame, level: int) -> bool:
    """Whether any node has shapes that still differ from ``level`` on."""
    rest = F.slice("shape", level + 1, F.greatest(F.size("shape"), F.lit(1)))
    ends = tree.groupBy("host", "template").agg(F.min(rest).alias("lo"), F.max(rest).alias("hi"))
    return ends.where("lo < hi").limit(1).count() > 0


def templates(shapes: DataFrame, depth: int | None = None, max_children: int = MAX_CHILDREN) -> DataFrame:
    """``shapes`` (host, shape, n, labels, blocked) with their ``template``."""
    tree = shapes.withColumn("template", F.lit(""))
    for level in count() if depth is None else range(depth + 1):
        if depth is None:
            tree = materialise(tree, "url-tree")
            if not _open(tree, level):  # what follows is the same for all shapes of a node
                rest = F.slice("shape", level + 1, F.greatest(F.size("shape"), F.lit(1)))
                return tree.withColumn("template", F.concat("template", F.array_join(F.transform(rest, lambda s: F.concat(F.lit("/"), s)), "")))
        branch = F.coalesce(F.get("shape", F.lit(level)), F.lit(""))  # empty: the path has ended
        tree = materialise(tree.withColumn("branch", branch), "url-tree")
        branches = tree.groupBy("host", "template", "branch").agg(*[F.sum(c).alias(c) for c in ("n", "labels", "blocked")])
        nodes = branches.groupBy("host", "template").agg(F.count(F.lit(1)).alias("all_branches"), *[F.sum(c).alias(f"all_{c}") for c in ("n", "labels", "blocked")])
        q = F.try_divide(F.col("all_blocked"), F.col("all_labels"))
        small = (F.col("all_branches") > max_children) & (F.col("n") * max_children <= F.col("all_n"))
        distance = F.abs(F.try_divide(F.col("blocked"), F.col("labels")) - q)
        alike = (F.col("all_branches") > 1) & (F.col("labels") >= MIN_LABELS) & (distance <= Z * F.sqrt(F.try_divide(q * (1 - q), F.col("labels"))))
        piece = F.when(F.col("branch") == "", "").when(small, "*").when(alike, "~").otherwise(F.col("branch"))
        named = branches.join(nodes, ["host", "template"]).select("host", "template", "branch", piece.alias("piece"))
        step = F.when(F.col("piece") == "", F.col("template")).otherwise(F.concat("template", F.lit("/"), "piece"))
        tree = tree.join(named, ["host", "template", "branch"]).withColumn("template", step).drop("branch", "piece")
    return tree


def _ancestors() -> Column:
    """(host, template) of a template, its parents up to its host, and the parent domains, nearest first."""
    pieces = F.split("template", "/")  # the first is empty
    node = lambda host, at: F.struct(host.alias("at_host"), at.alias("at"))
    within = F.transform(F.sequence(F.lit(0), F.size(pieces) - 1), lambda k: node(F.col("host"), F.array_join(F.slice(pieces, 1, F.size(pieces) - k), "/")))
    names = F.split("host", r"\.")
    domain = lambda k: F.concat(F.lit("."), F.array_join(F.slice(names, k + 1, F.size(names)), "."))
    domains = F.transform(F.sequence(F.lit(0), F.size(names) - 2), lambda k: node(domain(k), F.lit("")))
    return F.when(F.size(names) > 1, F.concat(within, domains)).otherwise(within)


def _nearest_labels(sums: DataFrame) -> DataFrame:
    """``sums`` (host, template, l, b) with the labels of the nearest node that has some; zeros when none has."""
    each = sums.select("host", "template", "l", "b", F.posexplode(_ancestors()).alias("distance", "node")).select("*", "node.*")
    pooled = each.where("l > 0").groupBy("at_host", "at").agg(F.sum("l").alias("near_l"), F.sum("b").alias("near_b"))
    found = each.select("host", "template", "distance", "at_host", "at").join(pooled, ["at_host", "at"])
    nearest = found.groupBy("host", "template").agg(F.min(F.struct("distance", "near_l", "near_b")).alias("near"))
    taken = [F.coalesce(f"near.near_{c}", F.lit(0)).alias(c) for c in ("l", "b")]
    return sums.select("host", "template").join(nearest, ["host", "template"], "left").select("host", "template", *taken)


def judged_templates(labelled: DataFrame, depth: int | None = None, max_children: int = MAX_CHILDREN, back_off: bool = True) -> DataFrame:
    """(host, shape, template, purity, reject) from ``labelled`` (host, path, label: 1 blocked, 0 allowed, or null)."""
    shapes = labelled.groupBy("host", shape_of(F.col("path"), depth).alias("shape")).agg(
        F.count(F.lit(1)).alias("n"), F.count("label").alias("labels"), F.coalesce(F.sum("label"), F.lit(0)).cast("bigint").alias("blocked")
    )
    tree = materialise(templates(shapes, depth, max_children), "url-templates")
    total = tree.agg(F.sum("blocked").alias("b"), F.sum("labels").alias("l")).first()
    prior = total.b / total.l if total.l else 0.0
    sums = tree.groupBy("host", "template").agg(F.sum("labels").alias("l"), F.sum("blocked").alias("b"))
    purity = (F.col("b") + WEIGHT * prior) / (F.col("l") + WEIGHT)
    reject = purity >= REJECT
    if back_off:
        sums, reject = _nearest_labels(sums), reject & (F.col("l") > 0)
    judged = sums.select("host", "template", purity.alias("purity"), reject.alias("reject"))
    return tree.select("host", "shape", "template").join(judged, ["host", "template"])


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, depth: int | None = None, max_children: int = MAX_CHILDREN, back_off: bool = True) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every row of ``pages`` (page_id, url)."""
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = parsed.withColumns({"rule": text, "ruled": verdict})
    label = F.when(F.col("ruled") == "block", 1).when(F.col("ruled") == "allow", 0)
    judged = judged_templates(ruled.select("host", "path", label.alias("label")), depth, max_children, back_off)
    spread = judged.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    keyed = ruled.withColumns({"shape": shape_of(F.col("path"), depth), "salt": F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")})
    met = keyed.join(spread, ["host", "shape", "salt"])
    final = F.coalesce("ruled", F.when(F.col("reject"), "block").otherwise("allow"))
    return met.select("page_id", "host", "path", "rule", final.alias("verdict"), "template", "purity")


def op4_url_filters(spark, sf_dir):
    return filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    rules = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))" for _, h, p in rules]
    texts = " ".join(f"WHEN {f} THEN '{h + p}'" for f, (_, h, p) in zip(fits, rules))
    labels = " ".join(f"WHEN {f} THEN {int(what == 'block')}" for f, (what, _, _) in zip(fits, rules))
    parts = [
        f"""parsed AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)://([^/?#]*)', 1), ''), '{UPPER}', '{SMALL}') AS host,
              coalesce(regexp_extract(url, '(?s)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)""",
        f"""ruled AS (SELECT *, list_filter(string_split(path, '/'), lambda s: s <> '') AS segments,
              CASE {texts} END AS rule, CASE {labels} END AS label FROM parsed)""",
        rf"""shaped AS (SELECT page_id, host, path, rule, label, list_transform(segments, lambda s: regexp_replace(s, '{IDENTIFIER}', '*\2')) AS shape FROM ruled)""",
        "t0 AS (SELECT host, shape, '' AS template, count(*) AS n, count(label) AS labels, coalesce(sum(label), 0) AS blocked FROM shaped GROUP BY host, shape)",
    ]
    for k in range(SQL_LEVELS):
        parts += [
            f"b{k} AS (SELECT host, template, coalesce(shape[{k + 1}], '') AS branch, sum(n) AS n, sum(labels) AS labels, sum(blocked) AS blocked FROM t{k} GROUP BY ALL)",
            f"n{k} AS (SELECT host, template, count(*) AS kids, sum(n) AS an, sum(labels) AS al, sum(blocked) AS ab FROM b{k} GROUP BY ALL)",
            f"""p{k} AS (SELECT host, template, branch, CASE WHEN branch = '' THEN '' WHEN kids > {MAX_CHILDREN} AND n * {MAX_CHILDREN} <= an THEN '*'
                  WHEN kids > 1 AND labels >= {MIN_LABELS} AND abs(blocked / labels - ab / al) <= {Z} * sqrt((ab / al) * (1 - ab / al) / labels) THEN '~' ELSE branch END AS piece
                FROM b{k} JOIN n{k} USING (host, template))""",
            f"""t{k + 1} AS (SELECT t.host, shape, CASE WHEN piece = '' THEN t.template ELSE t.template || '/' || piece END AS template, n, labels, blocked
                FROM t{k} t JOIN p{k} p ON t.host = p.host AND t.template = p.template AND coalesce(shape[{k + 1}], '') = p.branch)""",
        ]
    last = f"t{SQL_LEVELS}"
    parts += [
        f"prior AS (SELECT coalesce(sum(blocked) / nullif(sum(labels), 0), 0) AS p FROM {last})",
        f"""sums AS (SELECT host, template, sum(labels) AS l, sum(blocked) AS b, string_split(template, '/') AS pieces, string_split(host, '.') AS names
              FROM {last} GROUP BY host, template)""",
        """places AS (SELECT host, template, l, b, k AS distance, host AS at_host, array_to_string(pieces[1:len(pieces) - k], '/') AS at_template
              FROM (SELECT *, unnest(range(len(pieces))) AS k FROM sums)
            UNION ALL SELECT host, template, l, b, len(pieces) + k, '.' || array_to_string(names[k + 1:], '.'), ''
              FROM (SELECT *, unnest(range(len(names) - 1)) AS k FROM sums))""",
        "pooled AS (SELECT at_host, at_template, sum(l) AS near_l, sum(b) AS near_b FROM places WHERE l > 0 GROUP BY ALL)",
        "nearest AS (SELECT host, template, arg_min(near_l, distance) AS near_l, arg_min(near_b, distance) AS near_b FROM places JOIN pooled USING (at_host, at_template) GROUP BY host, template)",
        f"judged AS (SELECT host, template, (near_b + {WEIGHT} * p) / (near_l + {WEIGHT}) >= {REJECT} AS reject FROM nearest, prior)",
    ]
    return f"""WITH {', '.join(parts)}
SELECT s.page_id, s.host, s.path, s.rule, CASE WHEN label = 1 THEN 'block' WHEN label = 0 THEN 'allow' WHEN reject THEN 'block' ELSE 'allow' END AS verdict
FROM shaped s JOIN {last} t ON s.host = t.host AND s.shape = t.shape LEFT JOIN judged j ON t.host = j.host AND t.template = j.template"""


SQL = _sql()
