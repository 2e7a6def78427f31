"""Url filters: a tree of path templates per host, in DataFrame operations only.

Rules (host, path, verdict) decide the urls they fit; they are also the labels. Every path becomes a row of
segments with digits as ``#``. A host's tree is grown from its root, level by level:

* a node with ``MANY`` different children or more, seen fewer than ``RARE`` times each, has a variable segment:
  its children become one, ``*``;
* children of one node that continue with the same frequent segments (``NEXT_SHARE`` or more of their urls) and
  have a like share of blocked urls (to a quarter) are merged into one branch, so what follows them is pooled;
* a branch's share of blocked urls among its labelled ones is smoothed towards that of its parent, the root's
  towards that of the domain and of all urls.

A url is judged by the deepest node of its path: ``REJECT`` or above is blocked, all others are allowed. The tree has
``depth`` levels (a parameter); of longer paths the last level takes all the rest as one segment, so nothing is cut.

Null urls and urls without ``://`` have an empty host and path and no rule, and form a tree of their
own. Repeated rows give repeated results. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.rows import _q, stored

# (host, path, verdict), fixed values of the contract
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
DEPTH = 8
MANY = 20
RARE = 3
NEXT_SHARE = 0.05
WEIGHT = 5.0
REJECT = 0.75
SALTS = 16
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def parsed(df: DataFrame, url: str, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``df`` with ``__host``, ``__path``, ``__rule`` and ``__label`` (1: a rule blocks, 0: allows, null)."""
    text = F.coalesce(F.col(_q(url)).cast("string"), F.lit(""))
    start = F.instr(text, "://")
    rest = F.when(start > 0, F.substring(text, start + 3, F.length(text))).otherwise("")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    host, path = F.col("__host"), F.col("__path")
    rule: Column = F.lit(None).cast("string")
    label: Column = F.lit(None).cast("int")
    for own, prefix, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):  # the longest last, so outermost
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(prefix)
        rule = F.when(fits, own + prefix).otherwise(rule)
        label = F.when(fits, int(verdict == "block")).otherwise(label)
    out = df.withColumn("__host", F.translate(raw, _UPPER, _UPPER.lower())).withColumn("__path", after)
    return out.withColumn("__rule", rule).withColumn("__label", label)


def shapes(path: Column, depth: int = DEPTH) -> Column:
    """Segments with digits as ``#``; the last of ``depth`` levels holds all that is left."""
    segments = F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), lambda s: F.regexp_replace(s, "[0-9]+", "#"))
    rest = F.array_join(F.slice(segments, depth, F.greatest(F.size(segments), F.lit(1))), "/")
    return F.when(F.size(segments) > depth, F.concat(F.slice(segments, 1, depth - 1), F.array(rest))).otherwise(segments)


def _place(*columns: str) -> Column:
    """One of ``SALTS`` places of a row, as a bit: the rows of one key are met in all the places that they take."""
    return F.call_function("shiftleft", F.lit(1), F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int"))


def _spread(df: DataFrame, places: str, out: str = "place") -> DataFrame:
    """A copy of each row for each bit of ``places``, so there are never more copies than rows to meet."""
    bits = F.filter(F.array(*[F.lit(1 << k) for k in range(SALTS)]), lambda bit: F.col(places).bitwiseAND(bit) != 0)
    return df.withColumn(out, F.explode(bits)).drop(*([places] if places != out else []))


def _smooth(blocked: str, labelled: str, towards: str) -> Column:
    return (F.col(blocked) + WEIGHT * F.col(towards)) / (F.col(labelled) + WEIGHT)


def _roots(urls: DataFrame) -> DataFrame:
    """(host, share): the blocked share of each host, smoothed towards its domain's and that of all urls."""
    sums = [F.sum(c).alias(c) for c in ("labelled", "blocked")]
    whole = urls.agg(F.coalesce(F.sum("blocked"), F.lit(0)).alias("b"), F.coalesce(F.sum("labelled"), F.lit(0)).alias("m")).first()
    hosts = urls.groupBy(F.substring_index("host", ".", -2).alias("domain"), "host").agg(*sums, F.bit_or("place").alias("places"))
    # a domain of very many hosts: its row is met in as many places as its hosts take
    domains = hosts.withColumn("at", _place("host")).groupBy("domain").agg(F.sum("labelled").alias("dl"), F.sum("blocked").alias("db"), F.bit_or("at").alias("ats"))
    domains = domains.withColumn("p_all", F.lit((whole["b"] + 1) / (whole["m"] + 2))).withColumn("p_domain", _smooth("db", "dl", "p_all"))
    hosts = hosts.withColumn("at", _place("host")).join(_spread(domains.select("domain", "p_domain", "ats"), "ats", "at"), ["domain", "at"])
    return hosts.select("host", "places", _smooth("blocked", "labelled", "p_domain").alias("share"))


def branched(steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One level of the tree. ``steps``: (host, node, child, next, n, labelled, blocked, share, place), ``share`` being the
    node's and ``next`` what follows the child. Returns the variable nodes (host, node, places) and the branches (host, node,
    segment, name, share, places): each child, or ``*``, with the name and smoothed share of the branch it was merged into."""
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "blocked")]
    cells = stored(steps.groupBy("host", "node", "child", "next").agg(*sums, F.max("share").alias("share"), F.bit_or("place").alias("places")))
    cells = cells.withColumn("at", _place("child", "next"))
    children = cells.groupBy("host", "node", "child").agg(F.sum("n").alias("n"), F.bit_or("at").alias("ats"), F.bit_or("places").alias("places"))
    variable = children.groupBy("host", "node").agg(F.count("*").alias("c"), F.sum("n").alias("n"), F.bit_or("ats").alias("ats"), F.bit_or("places").alias("places"))
    variable = stored(variable.where((F.col("c") >= MANY) & (F.col("n") < RARE * F.col("c"))).select("host", "node", "ats", "places"))
    marked = cells.join(_spread(variable.drop("places"), "ats", "at").withColumn("wild", F.lit(True)), ["host", "node", "at"], "left")
    parts = marked.groupBy("host", "node", F.when(F.col("wild"), "*").otherwise(F.col("child")).alias("segment"), "next")
    parts = stored(parts.agg(*sums, F.max("share").alias("up"), F.bit_or("places").alias("places")).withColumn("at", _place("next")))
    segments = parts.groupBy("host", "node", "segment").agg(*sums, F.max("up").alias("up"), F.bit_or("places").alias("places"), F.bit_or("at").alias("ats"))
    totals = _spread(segments.select("host", "node", "segment", F.col("n").alias("all_n"), "ats"), "ats", "at")
    often = parts.join(totals, ["host", "node", "segment", "at"]).where(F.col("n") >= NEXT_SHARE * F.col("all_n"))
    marks = often.groupBy("host", "node", "segment").agg(F.sort_array(F.collect_set("next")).alias("marks"))  # 1 / NEXT_SHARE at most
    alike = segments.join(marks, ["host", "node", "segment"], "left").withColumn("marks", F.coalesce("marks", F.expr("cast(array() as array<string>)")))
    alike = stored(alike.withColumn("band", F.floor(_smooth("blocked", "labelled", "up") * 4)).withColumn("at", _place("segment")).drop("ats"))
    merged = alike.groupBy("host", "node", "marks", "band").agg(F.sum("labelled").alias("ml"), F.sum("blocked").alias("mb"), F.min("segment").alias("name"), F.bit_or("at").alias("ats"))
    branches = alike.join(_spread(merged, "ats", "at"), ["host", "node", "marks", "band", "at"])
    return variable.drop("ats"), branches.select("host", "node", "segment", "name", _smooth("mb", "ml", "up").alias("share"), "places")


def grown(urls: DataFrame) -> DataFrame:
    """(host, shape, node, share) for each distinct (host, shape) with counts n, labelled, blocked: the template of its
    deepest node and the blocked share there."""
    rows = urls.withColumn("place", _place("shape"))
    rows = stored(rows.join(_spread(_roots(rows), "places"), ["host", "place"]).withColumn("node", F.lit("")))
    depth = rows.agg(F.max(F.size("shape"))).first()[0] or 0
    done = [rows.where(F.size("shape") == 0)]
    for at in range(depth):
        live = rows.where(F.size("shape") > at).withColumn("child", F.get("shape", F.lit(at)))
        variable, branches = branched(live.withColumn("next", F.coalesce(F.get("shape", F.lit(at + 1)), F.lit(""))))
        wild = _spread(variable, "places").withColumn("wild", F.lit(True))
        live = live.join(wild, ["host", "node", "place"], "left").withColumn("segment", F.when(F.col("wild"), "*").otherwise(F.col("child"))).drop("share")
        live = live.join(_spread(branches, "places"), ["host", "node", "segment", "place"])
        rows = stored(live.select("host", "shape", "n", "labelled", "blocked", "place", "share", F.concat("node", F.lit("/"), "name").alias("node")))
        done.append(rows.where(F.size("shape") == at + 1))
    out = done[0].select("host", "shape", "node", "share")
    for level in done[1:]:
        out = out.unionByName(level.select("host", "shape", "node", "share"))
    return out


def judged(
    pages: DataFrame, url: str = "url", keep: Sequence[str] = ("page_id",), rules: Sequence[tuple[str, str, str]] = RULES, depth: int = DEPTH
) -> DataFrame:
    """``keep``, host, path, rule, verdict, and where no rule decides the template and blocked share of the deepest node."""
    keep = [c for c in keep if c not in ("host", "path", "rule", "verdict", "template", "share")]
    rows = parsed(pages.select(*[_q(c) for c in keep], F.col(_q(url)).alias("__url")), "__url", rules).withColumn("__shape", shapes(F.col("__path"), depth))
    # a host may hold a third of all rows: each of its shapes is met in as many places as its pages take
    rows = rows.withColumn("__place", _place("__url"))
    counts = (F.count("*").alias("n"), F.count("__label").alias("labelled"), F.coalesce(F.sum("__label"), F.lit(0)).alias("blocked"))
    urls = stored(rows.groupBy(F.col("__host").alias("host"), F.col("__shape").alias("shape")).agg(*counts, F.bit_or("__place").alias("pages")))
    tree = grown(urls).join(urls.select("host", "shape", "pages"), ["host", "shape"])
    tree = _spread(tree.select(F.col("host").alias("__host"), F.col("shape").alias("__shape"), F.col("node").alias("__node"), F.col("share").alias("__share"), "pages"), "pages", "__place")
    out = rows.join(tree, ["__host", "__shape", "__place"], "left")
    block = F.when(F.col("__label").isNotNull(), F.col("__label") == 1).otherwise(F.col("__share") >= REJECT)
    free = F.col("__rule").isNull()
    return out.select(
        *[_q(c) for c in keep],
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.col("__rule").alias("rule"),
        F.when(block, "block").otherwise("allow").alias("verdict"),
        F.when(free, F.col("__node")).alias("template"),
        F.when(free, F.col("__share")).alias("share"),
    )


def _oracle_level(i: int) -> str:
    """Level ``i`` (from 1) of the tree in SQL: from rows r{i - 1} to rows r{i}; ended rows pass unchanged."""
    return f"""
s{i} AS MATERIALIZED (SELECT *, shape[{i}] AS child, coalesce(shape[{i + 1}], '') AS nxt FROM r{i - 1} WHERE len(shape) >= {i}),
w{i} AS (SELECT host, node FROM s{i} GROUP BY ALL HAVING count(DISTINCT child) >= 20 AND sum(n) < 3 * count(DISTINCT child)),
x{i} AS MATERIALIZED (SELECT s{i}.*, CASE WHEN w{i}.host IS NULL THEN child ELSE '*' END AS seg FROM s{i} LEFT JOIN w{i} ON s{i}.host = w{i}.host AND s{i}.node = w{i}.node),
f{i} AS MATERIALIZED (SELECT host, node, seg, sum(n) AS n, sum(l) AS l, sum(b) AS b, any_value(p) AS up, floor((sum(b) + 5.0::DOUBLE * any_value(p)) / (sum(l) + 5.0::DOUBLE) * 4) AS band
    FROM x{i} GROUP BY ALL),
g{i} AS (SELECT host, node, seg, list(nxt ORDER BY nxt) AS marks FROM (SELECT host, node, seg, nxt, sum(n) AS tn FROM x{i} GROUP BY ALL) t JOIN f{i} USING (host, node, seg)
    WHERE tn >= 0.05::DOUBLE * n GROUP BY host, node, seg),
k{i} AS (SELECT f{i}.*, coalesce(marks, []) AS marks FROM f{i} LEFT JOIN g{i} USING (host, node, seg)),
v{i} AS MATERIALIZED (SELECT host, node, seg, min(seg) OVER w AS name, (sum(b) OVER w + 5.0::DOUBLE * up) / (sum(l) OVER w + 5.0::DOUBLE) AS share
    FROM k{i} WINDOW w AS (PARTITION BY host, node, marks, band)),
r{i} AS MATERIALIZED (SELECT x.host, x.shape, x.n, x.l, x.b, x.node || '/' || v.name AS node, v.share AS p FROM x{i} x JOIN v{i} v USING (host, node, seg)
    UNION ALL SELECT host, shape, n, l, b, node, p FROM r{i - 1} WHERE len(shape) < {i}),"""


ORACLE = (
    r"""
WITH cut AS (SELECT page_id, CASE WHEN url IS NOT NULL AND instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosted AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
named AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosted),
rules(rhost, rpath, bad) AS (VALUES ('org', '/', 0), ('example.org', '/es/', 1), ('example.org', '/en/1', 1), ('com', '/fr/', 0), ('com', '/de/', 1)),
fitting AS (SELECT host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(bad, length(rhost || rpath)) AS bad
    FROM (SELECT DISTINCT host, path FROM named), rules WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY host, path),
p AS (SELECT n.page_id, n.host, n.path, f.rule, f.bad,
    [regexp_replace(s, '[0-9]+', '#', 'g') FOR s IN string_split(n.path, '/') IF s <> ''] AS segs
    FROM named n LEFT JOIN fitting f USING (host, path)),
q AS (SELECT *, CASE WHEN len(segs) > 8 THEN list_append(segs[1:7], array_to_string(segs[8:], '/')) ELSE segs END AS shape FROM p),
u AS MATERIALIZED (SELECT host, shape, array_to_string(string_split(host, '.')[-2:], '.') AS dom, count(*) AS n, count(bad) AS l, coalesce(sum(bad), 0) AS b FROM q GROUP BY ALL),
a AS (SELECT (coalesce(sum(b), 0) + 1) / (coalesce(sum(l), 0) + 2) AS pa FROM u),
d AS (SELECT dom, (sum(b) + 5.0::DOUBLE * any_value(pa)) / (sum(l) + 5.0::DOUBLE) AS pd FROM u, a GROUP BY dom),
h AS (SELECT host, (sum(b) + 5.0::DOUBLE * any_value(pd)) / (sum(l) + 5.0::DOUBLE) AS ph FROM u JOIN d USING (dom) GROUP BY host),
r0 AS MATERIALIZED (SELECT host, shape, n, l, b, '' AS node, ph AS p FROM u JOIN h USING (host)),"""
    + "".join(_oracle_level(i) for i in range(1, DEPTH + 1))
    + f"""
z AS (SELECT * FROM r{DEPTH})"""
    + r"""
SELECT q.page_id, q.host, q.path, q.rule,
    CASE WHEN q.bad = 1 OR (q.bad IS NULL AND z.p >= 0.75) THEN 'block' ELSE 'allow' END AS verdict,
    CASE WHEN q.rule IS NULL THEN z.node END AS template
FROM q JOIN z ON q.host = z.host AND q.shape = z.shape
"""
)
