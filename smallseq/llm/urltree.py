"""URL filters: explicit rules, then a path-template tree judged by labelled purity. DataFrame functions only.

Paths are read segment by segment below their host, as deep as they go. Segments with digits are one variable segment from
the start; at each node, children whose labelled rate does not differ from the node's by more than chance are merged into
one wildcard branch (those without labels do not differ). Templates (the leaves) are rejected where their smoothed share of
bad labels is high: a template's rate leans on its host's, a host's on the whole table's. The tree is built on counts of
distinct masked paths, so a host of any size weighs no more than its distinct shapes; pages are joined to their template
once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialise

#: Branches within CHANCE squared standard errors of their node merge; labels that a prior weighs; the smoothed share of
#: bad labels from which a template is rejected.
CHANCE, PRIOR, REJECT = 1.0, 4.0, 0.5
#: Names of variable segments (with digits) and of merged branches; neither character can occur in a path.
DIGITS, MERGED = "#", "?"
#: Levels that the SQL reads (the operator has no such bound).
SQL_LEVELS = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (action, host/path): the contract's rules.
RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rules(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, action) of the longest rule that fits; null if none does. The rules are compiled into one expression."""

    def fits(rule: str) -> Column:
        at, _, rest = rule.partition("/")
        start = "/" + rest if "/" in rule else ""
        return ((host == at) | host.endswith("." + at)) & path.startswith(start)

    longest = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    pick = lambda values: F.coalesce(*[F.when(fits(r), F.lit(v)) for (_, r), v in zip(longest, values, strict=True)], F.lit(None).cast("string"))
    return pick([r for _, r in longest]), pick([a for a, _ in longest])


def with_segments(df: DataFrame) -> DataFrame:
    """Adds segs: the path's segments, those with digits masked."""
    parts = F.filter(F.split("path", "/"), lambda x: x != "")
    return df.withColumn("segs", F.transform(parts, lambda x: F.when(x.rlike("[0-9]"), DIGITS).otherwise(x)))


def _sums(prefix: str = "") -> list[Column]:
    return [F.sum(c).alias(prefix + c) for c in ("labelled", "bad")]


def grow(shapes: DataFrame) -> DataFrame:
    """(host, segs, labelled, bad) -> the same with ``template``, merged level by level from the root.

    A shape leaves the tree when its path has ended or when it is alone below its node; the loop ends when all have.
    """
    done = []
    tree = shapes.withColumn("template", F.lit(""))
    level = 0
    while True:
        tree = tree.withColumn("s", F.coalesce(F.get("segs", F.lit(level)), F.lit("")))
        child = tree.groupBy("host", "template", "s").agg(*_sums(), F.count("*").alias("shapes"))
        child = materialise(child, "children")
        node = child.groupBy("host", "template").agg(F.count("*").alias("kids"), *_sums("node_"))
        rate = F.col("node_bad") / F.greatest(F.col("node_labelled"), F.lit(1)).cast("double")
        off = F.col("bad") - rate * F.col("labelled")
        alike = (F.col("kids") > 1) & (off * off <= F.lit(CHANCE) * F.col("labelled") * rate * (F.lit(1.0) - rate))
        name = F.when(F.col("s") == "", "").when(alike, MERGED).otherwise(F.col("s"))
        named = materialise(child.join(node, ["host", "template"]).select("host", "template", "s", F.concat("template", F.lit("/"), name).alias("next"), "shapes"), "named")
        below = materialise(named.groupBy("host", "next").agg(F.sum("shapes").alias("shapes")), "below")
        tree = tree.join(named.drop("shapes"), ["host", "template", "s"]).join(below, ["host", "next"])
        rest = F.array_join(F.slice("segs", level + 2, F.greatest(F.size("segs") - level - 1, F.lit(1))), "/")
        ended = (F.size("segs") <= level) | (F.col("shapes") == 1)
        template = F.when(ended & (F.size("segs") > level + 1), F.concat("next", F.lit("/"), rest)).otherwise(F.col("next"))
        tree = materialise(tree.select("host", "segs", "labelled", "bad", template.alias("template"), ended.alias("ended")), "level")
        done.append(tree.where("ended").drop("ended"))
        tree = tree.where("not ended").drop("ended")
        if tree.isEmpty():
            break
        level += 1
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def judged_templates(shapes: DataFrame) -> DataFrame:
    """(host, segs, template, purity, rejected) of every masked path."""
    tree = grow(shapes)
    total = tree.agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled")).first()
    base = (total["bad"] or 0) / float(max(1, total["labelled"] or 0))
    hosts = tree.groupBy("host").agg(((F.sum("bad") + F.lit(PRIOR) * F.lit(base)) / (F.sum("labelled") + F.lit(PRIOR))).alias("host_rate"))
    leaves = tree.groupBy("host", "template").agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled")).join(materialise(hosts, "hosts"), "host")
    purity = (F.col("bad") + F.lit(PRIOR) * F.col("host_rate")) / (F.col("labelled") + F.lit(PRIOR))
    leaves = materialise(leaves.select("host", "template", purity.alias("purity"), (purity >= REJECT).alias("rejected")), "leaves")
    return tree.join(leaves, ["host", "template"]).select("host", "segs", "template", "purity", "rejected")


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """Per row of pages: page_id, host, path, rule, verdict, template, purity.

    ``labels`` has (page_id, bad boolean); rows without an id or a label are left out, repeated ids count as bad if any is.
    verdict: the longest fitting rule's action, else block where the template is rejected, else allow. A null url, or one
    without ``://``, has empty host and path and is judged like any other path of the empty host. Rows stay rows, those
    that repeat an id too; other columns of pages are not read, whatever their names. No pages give no rows.
    """
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = labels.where("page_id is not null and bad is not null").groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("label"))
    rows = with_segments(rows)
    shapes = rows.join(known, "page_id", "left").groupBy("host", "segs").agg(F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).alias("bad"))
    templates = broadcast_if_small(materialise(judged_templates(materialise(shapes, "shapes")), "templates"))
    rule, action = match_rules(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(action, F.when(F.col("rejected"), "block").otherwise("allow"))
    return rows.join(templates, ["host", "segs"]).select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "template", "purity")


def allowed(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """page_id of the pages that are not blocked."""
    return judge(pages, labels, rules).where("verdict = 'allow'").select("page_id")


def oracle() -> str:
    """DuckDB SQL for judge() without its last two columns; labels: quality = 0 of the document of that id."""
    levels = [f"s{i}" for i in range(1, SQL_LEVELS + 1)]
    rules = sorted(RULES, key=lambda r: (-len(r[1]), r[1]))
    fits = lambda r: f"((host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}'))"
    case = lambda pick: "CASE " + " ".join(f"WHEN {fits(r)} THEN '{pick(a, r)}'" for a, r in rules) + " END"
    key = ["host", *levels]
    steps = []
    before = "shapes0"
    for i, s in enumerate(levels):
        steps.append(f"""child{i} AS (SELECT host, template, {s}, sum(labelled) AS labelled, sum(bad) AS bad FROM {before} GROUP BY ALL),
node{i} AS (SELECT host, template, count(*) AS kids, CAST(sum(labelled) AS DOUBLE) AS node_labelled, CAST(sum(bad) AS DOUBLE) AS node_bad FROM child{i} GROUP BY ALL),
named{i} AS (SELECT host, template, {s}, template || '/' || CASE WHEN {s} = '' THEN ''
  WHEN kids > 1 AND (bad - rate * labelled) * (bad - rate * labelled) <= {CHANCE}::DOUBLE * labelled * rate * (1.0::DOUBLE - rate) THEN '{MERGED}' ELSE {s} END AS next
  FROM (SELECT *, node_bad / greatest(node_labelled, 1) AS rate FROM child{i} JOIN node{i} USING (host, template))),
level{i} AS (SELECT t.* REPLACE (next AS template) FROM {before} t JOIN named{i} m ON t.host = m.host AND t.template = m.template AND t.{s} = m.{s})""")
        before = f"level{i}"
    masked = ", ".join(f"coalesce(CASE WHEN regexp_matches(parts[{i}], '[0-9]') THEN '{DIGITS}' ELSE parts[{i}] END, '') AS s{i}" for i in range(1, SQL_LEVELS + 1))
    return f"""
WITH u AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), p AS (
  SELECT *, {masked} FROM (SELECT *, [x FOR x IN string_split(path, '/') IF x <> ''] AS parts FROM u)
), l AS (SELECT doc_id, max(CASE WHEN quality = 0 THEN 1 ELSE 0 END) AS label FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
shapes0 AS (
  SELECT {", ".join(key)}, '' AS template, count(label) AS labelled, coalesce(sum(label), 0) AS bad FROM p LEFT JOIN l ON page_id = doc_id GROUP BY ALL
), {", ".join(steps)},
hosts AS (SELECT host, (sum(bad) + {PRIOR}::DOUBLE * (SELECT sum(bad)::DOUBLE / greatest(sum(labelled), 1) FROM {before})) / (sum(labelled) + {PRIOR}::DOUBLE) AS host_rate FROM {before} GROUP BY host),
leaves AS (
  SELECT host, template, (bad + {PRIOR}::DOUBLE * host_rate) / (labelled + {PRIOR}::DOUBLE) >= {REJECT}::DOUBLE AS rejected
  FROM (SELECT host, template, sum(bad) AS bad, sum(labelled) AS labelled FROM {before} GROUP BY ALL) JOIN hosts USING (host)
)
SELECT page_id, host, path, {case(lambda a, r: r)} AS rule, coalesce({case(lambda a, r: a)}, CASE WHEN rejected THEN 'block' ELSE 'allow' END) AS verdict
FROM p JOIN {before} USING ({", ".join(key)}) JOIN leaves USING (host, template)
"""
