"""The queries over the driver's tables and their SQL.

Every operator family of the engine has a query here that runs over a whole
table; the SQL beside it states the same for DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparquill.functions import names, pseudocode, registry
from sparquill.functions import text as T
from sparquill.operators import dispatch, folds, forms, render, reports, sections, tables, validate
from sparquill.sources import fonts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def count() -> Column:
    return F.count("*").cast("long")


def long(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


# -- lines and sections -----------------------------------------------------

_LINES = "(SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents)"


def _lines(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


@query(
    f"""
WITH l AS (SELECT *, CASE WHEN len(trim(line)) BETWEEN 1 AND 40 THEN pos END AS head FROM {_LINES}),
s AS (SELECT *, last_value(head IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos) AS section FROM l)
SELECT doc_id, CAST(coalesce(section, -1) AS BIGINT) AS section, count(*) AS n_lines, CAST(sum(len(line)) AS BIGINT) AS n_chars,
  max(CASE WHEN pos = section THEN trim(line) END) AS heading
FROM s GROUP BY ALL
"""
)
def doc_sections(table):
    """Lines carried under the last heading before them, collected per section."""
    head = F.when(F.length(F.trim("line")).between(1, 40), F.col("pos"))
    lines = folds.carry_forward(_lines(table("documents")).withColumn("head", head), "head", ["doc_id"], ["pos"], "section")
    return lines.groupBy("doc_id", long(F.coalesce("section", F.lit(-1))).alias("section")).agg(
        count().alias("n_lines"), long(F.sum(F.length("line"))).alias("n_chars"), F.max(F.when(F.col("pos") == F.col("section"), F.trim("line"))).alias("heading")
    )


@query(
    f"""
SELECT doc_id, CAST(pos AS BIGINT) AS pos,
  CASE WHEN len(line) > 400 THEN 'Title' WHEN len(line) > 200 THEN 'Heading' WHEN len(line) > 40 THEN 'Body' ELSE 'SmallText' END AS class,
  CASE WHEN starts_with(t, 'Opcode') OR t IN ('Instruction', 'Instruction Operand Encoding') THEN 'Instruction' WHEN t = 'Description' THEN 'Description'
    WHEN t = 'Operation' THEN 'Operation' WHEN t IN ('Flags Affected', 'FPU Flags Affected') THEN 'FlagsAffected' WHEN contains(t, 'Intrinsic') THEN 'Intrinsic'
    WHEN ends_with(t, 'Exceptions') THEN 'Exceptions' WHEN starts_with(t, 'Table ') OR t IN ('Effective Operand Size', 'NOTES') THEN 'Other' END AS section
FROM (SELECT *, trim(line) AS t FROM {_LINES})
"""
)
def doc_line_classes(table):
    """Size class and section rule of every line; lengths stand for font scales."""
    n = F.length("line")
    size = T.first_of((n > 400, "Title"), (n > 200, "Heading"), (n > 40, "Body"), default="SmallText")
    return _lines(table("documents")).select("doc_id", long("pos").alias("pos"), size.alias("class"), T.detect_section(F.col("line")).alias("section"))


@query(
    r"""
SELECT doc_id, CAST(len(p) AS BIGINT) AS n, array_to_string([CASE WHEN ends_with(x, '.') THEN x ELSE x || '.' END FOR x IN p], '|') AS sentences
FROM (SELECT doc_id, list_filter(string_split(text, '. '), lambda x: trim(x) <> '') AS p FROM documents)
"""
)
def doc_sentences(table):
    return table("documents").select("doc_id", T.sentences(F.col("text")).alias("s")).select("doc_id", long(F.size("s")).alias("n"), F.array_join("s", "|").alias("sentences"))


@query(r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS plain FROM documents")
def ws_normalize(table):
    return table("documents").select("doc_id", T.normalize_whitespace(F.col("text")).alias("plain"))


@query(f"SELECT event_id, translate(props, '{T.SUPER[0]}', '{T.SUPER[1]}') AS raised, translate(props, '{T.SUB[0]}', '{T.SUB[1]}') AS lowered FROM events")
def char_substitution(table):
    return table("events").select("event_id", T.superscript(F.col("props")).alias("raised"), T.subscript(F.col("props")).alias("lowered"))


@query("SELECT doc_id, CAST(len(text) - len(replace(text, '#', '')) AS BIGINT) AS n_junk, CAST((len(text) - len(replace(text, '!!', ''))) // 2 AS BIGINT) AS n_bangs FROM documents")
def replacement_count(table):
    return table("documents").select("doc_id", T.occurrences(F.col("text"), "#").alias("n_junk"), T.occurrences(F.col("text"), "!!").alias("n_bangs"))


@query(
    r"""
WITH t AS (SELECT p_partkey, upper(p_type) || ' - ' || p_name AS title FROM part), n AS (SELECT *, trim(split_part(title, ' - ', 1)) AS name FROM t)
SELECT p_partkey, regexp_matches(trim(title), '^[A-Z]') AND regexp_matches(name, '^[A-Z0-9/,\[\] .]+$') AND regexp_matches(name, '[A-Z]{2}') AS is_title,
  name AS title, trim(substr(title, instr(title, ' - ') + 3)) AS summary FROM n
"""
)
def title_predicate(table):
    title = F.concat(F.upper("p_type"), F.lit(" - "), "p_name")
    parsed = T.parse_title(title)
    return table("part").select("p_partkey", T.is_title(title).alias("is_title"), parsed["title"].alias("title"), parsed["summary"].alias("summary"))


# -- markup -----------------------------------------------------------------

_TAGS = r"'<(/?[a-z][a-z0-9]*)[^>]*>'"


@query(
    rf"""
SELECT page_id, tag, count(*) AS n, CAST(min(pos) AS BIGINT) AS first_pos
FROM (SELECT page_id, unnest(t) AS tag, unnest(range(len(t))) AS pos FROM (SELECT page_id, regexp_extract_all(html, {_TAGS}, 1) AS t FROM pages)) GROUP BY ALL
"""
)
def html_sections(table):
    tags = table("pages").select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r"<(/?[a-z][a-z0-9]*)[^>]*>"), 1)).alias("pos", "tag"))
    return tags.groupBy("page_id", "tag").agg(count().alias("n"), long(F.min("pos")).alias("first_pos"))


@query(
    r"""
SELECT page_id, CAST(len(a) AS BIGINT) AS n, array_to_string(a, ' ') AS links, regexp_extract(html, 'lang="([^"]*)"', 1) AS lang
FROM (SELECT page_id, html, regexp_extract_all(html, 'href="([^"]*)"', 1) AS a FROM pages)
"""
)
def html_attrs(table):
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)
    return table("pages").select("page_id", long(F.size(links)).alias("n"), F.array_join(links, " ").alias("links"), F.regexp_extract("html", 'lang="([^"]*)"', 1).alias("lang"))


@query(
    rf"""
WITH t AS (SELECT page_id, unnest(t) AS tag, unnest(range(len(t))) AS pos FROM (SELECT page_id, regexp_extract_all(html, {_TAGS}, 1) AS t FROM pages)),
u AS (SELECT *, CASE WHEN tag IN ('meta', 'br') THEN 0 WHEN starts_with(tag, '/') THEN -1 ELSE 1 END AS step FROM t),
d AS (SELECT page_id, step, sum(step) OVER (PARTITION BY page_id ORDER BY pos) AS depth FROM u)
SELECT page_id, CAST(max(depth) AS BIGINT) AS deepest, CAST(sum(step) AS BIGINT) AS last_depth FROM d GROUP BY ALL
"""
)
def html_depth(table):
    tags = table("pages").select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r"<(/?[a-z][a-z0-9]*)[^>]*>"), 1)).alias("pos", "tag"))
    step = F.when(F.col("tag").isin("meta", "br"), 0).when(F.col("tag").startswith("/"), -1).otherwise(1)
    deep = folds.running_sum(tags.withColumn("step", step), "step", ["page_id"], ["pos"], "depth")
    return deep.groupBy("page_id").agg(long(F.max("depth")).alias("deepest"), long(F.sum("step")).alias("last_depth"))


# -- ordered state ----------------------------------------------------------


@query(
    """
SELECT event_id, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER w % 2 AS BIGINT) AS inside,
  coalesce(lag(event_type) OVER w, '') AS before, coalesce(lead(event_type) OVER w, '') AS after
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)
"""
)
def toggle_segments(table):
    """A flag that each error turns on or off, with the rows beside."""
    w = Window.partitionBy("user_id").orderBy("event_id")
    on = folds.running_sum(table("events").withColumn("fence", (F.col("event_type") == "error").cast("int")), "fence", ["user_id"], ["event_id"], "fences")
    return on.select("event_id", long(F.col("fences") % 2).alias("inside"), F.coalesce(F.lag("event_type").over(w), F.lit("")).alias("before"), F.coalesce(F.lead("event_type").over(w), F.lit("")).alias("after"))


@query(
    """
WITH e AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS epoch FROM events)
SELECT event_id, CAST(epoch AS BIGINT) AS epoch, round(sum(value) OVER (PARTITION BY user_id, epoch ORDER BY event_id), 4) AS pen FROM e
"""
)
def state_replay(table):
    """An absolute set (error) opens an epoch; other rows add to the value of theirs."""
    return folds.replay(table("events"), F.col("event_type") == "error", "value", ["user_id"], ["event_id"]).select(
        "event_id", long("epoch").alias("epoch"), F.round("state", 4).alias("pen")
    )


@query(
    """
SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS last_price,
  last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS last_signup FROM events
"""
)
def carry_forward(table):
    e = table("events")
    e = folds.carry_forward(e.withColumn("p", F.when(F.col("event_type") == "purchase", F.col("value"))), "p", ["user_id"], ["event_id"], "last_price")
    return folds.carry_forward(e.withColumn("s", F.when(F.col("event_type") == "signup", F.col("event_id"))), "s", ["user_id"], ["event_id"], "last_signup").select(
        "event_id", "last_price", "last_signup"
    )


@query(
    """
SELECT o_custkey, o_orderkey AS low, lead(o_orderkey) OVER w AS high, CAST(row_number() OVER w - 1 AS BIGINT) AS band FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey) QUALIFY high IS NOT NULL
"""
)
def adjacent_bands(table):
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    return table("orders").select("o_custkey", F.col("o_orderkey").alias("low"), F.lead("o_orderkey").over(w).alias("high"), long(F.row_number().over(w) - 1).alias("band")).where("high is not null")


@query(
    """
WITH l AS (SELECT l_orderkey, list(l_quantity ORDER BY l_linenumber, l_quantity) AS q FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, array_to_string(list_transform(list_reduce(q, lambda acc, x: CASE WHEN len(list_filter(acc, lambda y: abs(y - x[1]) < 2)) > 0 THEN acc ELSE list_append(acc, x[1]) END, []), lambda v: CAST(CAST(floor(v) AS BIGINT) AS VARCHAR)), ',') AS bands
FROM (SELECT l_orderkey, list_transform(q, lambda v: [v]) AS q FROM l)
"""
)
def tolerance_bands(table):
    """Distinct quantities of an order within a tolerance; the first of each band stands for it."""
    q = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity"))), lambda s: s["l_quantity"])
    bands = table("lineitem").groupBy("l_orderkey").agg(folds.tolerance_distinct(q, 2.0).alias("b"))
    return bands.select("l_orderkey", F.array_join(F.transform("b", lambda v: F.floor(v).cast("long").cast("string")), ",").alias("bands"))


# -- geometry over line items -----------------------------------------------

_BOX = "SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS BIGINT) AS l_linenumber, l_quantity AS x0, l_discount * 100 AS y0, l_quantity + l_tax * 100 AS x1, l_discount * 100 + 2 AS y1 FROM lineitem"


def _boxes(table) -> DataFrame:
    q, d = F.col("l_quantity"), F.col("l_discount") * 100
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))
    return table("lineitem").select("l_orderkey", long(number).alias("l_linenumber"), q.alias("x0"), d.alias("y0"), (q + F.col("l_tax") * 100).alias("x1"), (d + 2).alias("y1"))


@query(f"SELECT l_orderkey, round(min(x0), 6) AS x0, round(min(y0), 6) AS y0, round(max(x1), 6) AS x1, round(max(y1), 6) AS y1, count(*) AS n FROM ({_BOX}) GROUP BY l_orderkey")
def bounding_boxes(table):
    return _boxes(table).groupBy("l_orderkey").agg(
        *(F.round(f(c), 6).alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))), count().alias("n")
    )


_PAIRS = f"""
b AS ({_BOX}),
p AS (SELECT a.l_orderkey, a.l_linenumber AS i, c.l_linenumber AS j FROM b a JOIN b c ON a.l_orderkey = c.l_orderkey AND a.l_linenumber < c.l_linenumber
  AND a.x0 <= c.x1 AND c.x0 <= a.x1 AND a.y0 <= c.y1 AND c.y0 <= a.y1)"""


@query(f"WITH {_PAIRS} SELECT l_orderkey, i, j FROM p")
def rect_overlap_pairs(table):
    return folds.overlapping(_boxes(table), "l_orderkey", "l_linenumber").select("l_orderkey", "i", "j")


@query(
    f"""
WITH RECURSIVE {_PAIRS},
e AS (SELECT l_orderkey, i, j FROM p UNION SELECT l_orderkey, j, i FROM p),
r(l_orderkey, l_linenumber, root) AS (
  SELECT l_orderkey, l_linenumber, l_linenumber FROM b
  UNION SELECT r.l_orderkey, e.j, r.root FROM r JOIN e ON r.l_orderkey = e.l_orderkey AND r.l_linenumber = e.i)
SELECT l_orderkey, l_linenumber, min(root) AS component FROM r GROUP BY ALL
"""
)
def overlap_components(table):
    """Connected groups of overlapping boxes of an order, by their smallest line number."""
    return folds.overlap_components(_boxes(table), "l_orderkey", "l_linenumber").select("l_orderkey", "l_linenumber", "component")


@query(
    """
WITH c AS (SELECT p_partkey, p_size AS lo, p_size + 5 AS hi, p_partkey % 50 AS page FROM part)
SELECT l_orderkey, l_linenumber, min(p_partkey) AS cell FROM lineitem JOIN c ON l_partkey % 50 = page AND l_quantity BETWEEN lo - 1 AND hi + 1 GROUP BY ALL
"""
)
def point_in_cell(table):
    """The first cell of the page that holds a point, with a tolerance of one."""
    cells = table("part").select("p_partkey", F.col("p_size").alias("lo"), (F.col("p_size") + 5).alias("hi"), (F.col("p_partkey") % 50).alias("page"))
    points = table("lineitem").withColumn("page", F.col("l_partkey") % 50)
    return folds.first_range_match(points, cells, "page", "l_quantity", ("lo", "hi"), 1, ["l_orderkey", "l_linenumber"], "p_partkey", "cell")


@query(
    """
WITH c AS (SELECT l_orderkey, l_linenumber, string_agg(l_returnflag || l_linestatus, ' ' ORDER BY l_partkey, l_suppkey, l_returnflag, l_linestatus) AS t FROM lineitem GROUP BY ALL),
n AS (SELECT l_orderkey, max(l_linenumber) AS n FROM c GROUP BY ALL),
g AS (SELECT n.l_orderkey, unnest(range(1, n.n + 1)) AS k FROM n)
SELECT g.l_orderkey, '| ' || string_agg(coalesce(c.t, ''), ' | ' ORDER BY g.k) || ' |' AS row FROM g LEFT JOIN c ON g.l_orderkey = c.l_orderkey AND g.k = c.l_linenumber GROUP BY ALL
"""
)
def grid_pivot(table):
    """Cells joined in order, laid on a full grid of columns, empty where none is."""
    cells = table("lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"))), lambda s: F.concat(s["l_returnflag"], s["l_linestatus"])), " ").alias("t")
    )
    return folds.grid_rows(cells, ["l_orderkey"], "l_linenumber", "t").select("l_orderkey", T.markdown_row(F.col("cells")).alias("row"))


@query(
    """
SELECT p.event_id, h.event_id AS heading, round(p.value - h.value, 6) AS distance
FROM (SELECT * FROM events WHERE event_type = 'purchase') p LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') h ON p.user_id = h.user_id AND h.value <= p.value
QUALIFY row_number() OVER (PARTITION BY p.event_id ORDER BY h.value DESC, h.event_id) = 1
"""
)
def nearest_above(table):
    """The nearest heading (signup) at or below each row's value, the earlier of equal ones."""
    e = table("events")
    heads = e.where("event_type = 'signup'").select(F.col("user_id").alias("u"), F.col("event_id").alias("heading"), F.col("value").alias("at"))
    return folds.nearest(e.where("event_type = 'purchase'"), heads, ("user_id", "u"), "value", "at", "heading").select(
        "event_id", "heading", F.round(F.col("value") - F.col("at"), 6).alias("distance")
    )


# -- joins and keys ---------------------------------------------------------


@query("SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)")
def anti_consumed(table):
    return table("customer").join(table("orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("SELECT n_name, count(s_suppkey) AS n, CAST(min(s_suppkey) AS BIGINT) AS first FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name")
def name_join(table):
    return table("nation").join(table("supplier"), F.col("s_nationkey") == F.col("n_nationkey"), "left").groupBy("n_name").agg(long(F.count("s_suppkey")).alias("n"), long(F.min("s_suppkey")).alias("first"))


@query(
    """
SELECT l_suppkey, l_quantity AS upper_median FROM (
  SELECT l_suppkey, l_quantity, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) AS r, count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem) WHERE r = n // 2 + 1
"""
)
def upper_median(table):
    """The element at n div 2 of the sorted values, from counts of distinct values, so a group is never collected."""
    return folds.upper_median(table("lineitem"), ["l_suppkey"], "l_quantity", "upper_median")


@query(
    """
SELECT l_orderkey, l_quantity AS dominant, n FROM (SELECT l_orderkey, l_quantity, count(*) AS n, min(l_linenumber) AS seen FROM lineitem GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, seen DESC, l_quantity DESC) = 1
"""
)
def dominant_bucket(table):
    """The most frequent value; among equals the one first seen last."""
    n = table("lineitem").groupBy("l_orderkey", "l_quantity").agg(count().alias("n"), F.min("l_linenumber").alias("seen"))
    best = F.max(F.struct("n", "seen", "l_quantity"))
    return n.groupBy("l_orderkey").agg(best.alias("m")).select("l_orderkey", F.col("m.l_quantity").alias("dominant"), F.col("m.n").alias("n"))


@query("SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS status, min(o_orderkey) AS at FROM orders GROUP BY o_custkey")
def first_per_key(table):
    return table("orders").groupBy("o_custkey").agg(F.min_by("o_orderstatus", "o_orderkey").alias("status"), F.min("o_orderkey").alias("at"))


@query("SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS status, max(o_orderkey) AS at FROM orders GROUP BY o_custkey")
def last_per_key(table):
    return table("orders").groupBy("o_custkey").agg(F.max_by("o_orderstatus", "o_orderkey").alias("status"), F.max("o_orderkey").alias("at"))


@query(
    """
SELECT p_partkey, v || CASE WHEN k = 0 THEN '' ELSE '_' || k END AS variant FROM (
  SELECT p_partkey, upper(p_name[1]) || lower(p_name[2:]) AS v, row_number() OVER (PARTITION BY upper(p_name[1]) || lower(p_name[2:]) ORDER BY p_partkey) - 1 AS k FROM part)
"""
)
def dup_suffix(table):
    variant = F.concat(F.upper(F.substring("p_name", 1, 1)), F.lower(F.expr("substring(p_name, 2)")))
    return folds.suffixed(table("part").withColumn("v", variant), "v", ["p_partkey"], "variant").select("p_partkey", "variant")


@query(
    """
SELECT p_partkey, coalesce(CASE p_type WHEN 'ECONOMY ANODIZED STEEL' THEN 'template' END,
  CASE WHEN regexp_matches(p_type, '^PROMO.*BRASS') THEN 'cc' END,
  CASE WHEN regexp_matches(p_type, '^(SMALL|LARGE)') THEN 'size' WHEN regexp_matches(p_type, '(TIN|STEEL)$') THEN 'metal' WHEN regexp_matches(p_type, '^S') THEN 's' END, 'fallback') AS rule
FROM part
"""
)
def ranked_dispatch(table):
    """Exact key, then condition code, then the first of ranked patterns, then a fallback."""
    kind = F.col("p_type")
    exact = F.when(kind == "ECONOMY ANODIZED STEEL", "template")
    code = F.when(kind.rlike("^PROMO.*BRASS"), "cc")
    pattern = T.first_of((kind.rlike("^(SMALL|LARGE)"), "size"), (kind.rlike("(TIN|STEEL)$"), "metal"), (kind.rlike("^S"), "s"))
    return table("part").select("p_partkey", F.coalesce(exact, code, pattern, F.lit("fallback")).alias("rule"))


@query("SELECT o_orderkey, o_orderstatus FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)")
def unconsumed(table):
    """Rows whose key no row of another table took; some have none."""
    return table("orders").join(table("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey", "o_orderstatus")


# -- sets, rules, reports ---------------------------------------------------

_SETS = r"SELECT doc_id, list_sort(list_distinct(regexp_extract_all(text, '[!#$%&|]+'))) AS ops, list_sort(list_distinct(regexp_extract_all(lang || source || n_chars, '[0-9]'))) AS digits FROM documents"


def _sets(table) -> DataFrame:
    every = lambda c, p: F.sort_array(F.array_distinct(F.regexp_extract_all(c, F.lit(p), 0)))
    return table("documents").select("doc_id", every(F.col("text"), "[!#$%&|]+").alias("ops"), every(F.concat("lang", "source", F.col("n_chars").cast("string")), "[0-9]").alias("digits"))


@query(f"SELECT doc_id, array_to_string(ops, ' ') AS ops, array_to_string(digits, ' ') AS digits FROM ({_SETS})")
def signature_sets(table):
    return _sets(table).select("doc_id", F.array_join("ops", " ").alias("ops"), F.array_join("digits", " ").alias("digits"))


@query(
    f"""
SELECT doc_id, array_to_string(list_filter(digits, lambda d: NOT list_contains(['0', '1', '2', '3'], d)), ' ') AS extra,
  array_to_string(list_filter(['0', '1', '2', '3'], lambda d: NOT list_contains(digits, d)), ' ') AS missing,
  list_has_any(digits, ['0', '1', '2', '3']) AS meets FROM ({_SETS})
"""
)
def signature_diff(table):
    expected = F.array(*map(F.lit, "0123"))
    return _sets(table).select(
        "doc_id",
        F.array_join(F.array_except("digits", expected), " ").alias("extra"),
        F.array_join(F.array_except(expected, "digits"), " ").alias("missing"),
        F.arrays_overlap("digits", expected).alias("meets"),
    )


_RULES = """
SELECT d.doc_id, lang, quality, list_filter([CASE WHEN contains(text, '!!') THEN 'loud' END, CASE WHEN contains(text, '|') THEN 'minor: table' END,
  CASE WHEN n_chars < 200 THEN 'minor: short' END], lambda x: x IS NOT NULL) AS issues FROM documents d JOIN labels l USING (doc_id)"""
_VERDICT = "CASE WHEN quality IS NULL THEN 'EXCEPTION_STUB' WHEN len(issues) = 0 THEN 'CORRECT' WHEN len(list_filter(issues, lambda x: NOT starts_with(x, 'minor'))) = 0 THEN 'ACCEPTABLE' ELSE 'WRONG' END"


def _judged(table) -> DataFrame:
    docs = table("documents").join(table("labels"), "doc_id")
    rules = [(F.contains("text", F.lit("!!")), "loud"), (F.contains("text", F.lit("|")), "minor: table"), (F.col("n_chars") < 200, "minor: short")]
    issues = validate.issues(rules)
    return docs.withColumn("issues", issues).withColumn("verdict", validate.verdict(F.col("issues"), F.col("quality").isNull(), minor="^minor"))


@query(f"SELECT doc_id, array_to_string(issues, ';') AS issues, {_VERDICT} AS verdict FROM ({_RULES})")
def rule_verdicts(table):
    return _judged(table).select("doc_id", F.array_join("issues", ";").alias("issues"), "verdict")


@query(
    f"""
SELECT lang, CAST(quality AS INTEGER) AS quality, CAST(grouping(lang, quality) AS BIGINT) AS level, count(*) AS n, count(*) FILTER (verdict = 'CORRECT') AS n_correct,
  count(*) FILTER (verdict = 'ACCEPTABLE') AS n_acceptable, count(*) FILTER (verdict = 'WRONG') AS n_wrong, CAST(100 * count(*) FILTER (verdict = 'CORRECT') // count(*) AS BIGINT) AS percent
FROM (SELECT *, {_VERDICT} AS verdict FROM ({_RULES})) GROUP BY ROLLUP (lang, quality)
"""
)
def verdict_rollup(table):
    return validate.report(_judged(table), ["lang", "quality"])


@query("SELECT upper(c_name[1]) || c_mktsegment[1] AS letter, count(*) AS n, CAST(min(c_custkey) AS BIGINT) AS first, CAST(max(c_custkey) AS BIGINT) AS last FROM customer GROUP BY ALL")
def letter_counts(table):
    """Groups by first letters; their members are never collected."""
    letter = F.concat(F.upper(F.substring("c_name", 1, 1)), F.substring("c_mktsegment", 1, 1))
    return table("customer").groupBy(letter.alias("letter")).agg(count().alias("n"), long(F.min("c_custkey")).alias("first"), long(F.max("c_custkey")).alias("last"))


@query(f"SELECT doc_id, array_to_string(issues, ';') AS issues FROM ({_RULES}) WHERE len(issues) > 0 ORDER BY len(issues) DESC, doc_id LIMIT 50")
def top_errors(table):
    """The report's first fifty documents with issues; the limit is the feature."""
    bad = _judged(table).where(F.size("issues") > 0)
    return bad.orderBy(F.size("issues").desc(), "doc_id").limit(50).select("doc_id", F.array_join("issues", ";").alias("issues"))


@query(
    """
SELECT conv_id, string_agg(role, ',' ORDER BY seen) AS roles, count(*) AS n FROM (SELECT conv_id, role, min(turn) AS seen FROM conversations GROUP BY ALL) GROUP BY conv_id
"""
)
def distinct_notes(table):
    """Distinct values in order of first appearance."""
    first = table("conversations").groupBy("conv_id", "role").agg(F.min("turn").alias("seen"))
    return first.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seen", "role"))), lambda s: s["role"]), ",").alias("roles"), count().alias("n"))


@query("SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_discount DESC, l_quantity, l_linenumber) AS place FROM lineitem")
def page_order(table):
    w = Window.partitionBy("l_orderkey").orderBy(F.desc("l_discount"), "l_quantity", "l_linenumber")
    return table("lineitem").select("l_orderkey", "l_linenumber", long(F.row_number().over(w)).alias("place"))


_RANGES = ((None, 1000), (1000, 3500), (3500, None))


@query(
    " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS range_id, o_orderkey, o_orderstatus FROM orders WHERE {' AND '.join([f'o_orderkey >= {a}'] * (a is not None) + [f'o_orderkey < {b}'] * (b is not None))}"
        for i, (a, b) in enumerate(_RANGES)
    )
)
def key_ranges(table):
    """Half-open key ranges that cover all rows, appended in order with their number."""
    key, parts = F.col("o_orderkey"), []
    for i, (a, b) in enumerate(_RANGES):
        inside = (F.lit(True) if a is None else key >= a) & (F.lit(True) if b is None else key < b)
        parts.append(table("orders").where(inside).select(F.lit(i).cast("long").alias("range_id"), "o_orderkey", "o_orderstatus"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    """
SELECT r_name, '| nation | key |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || n_name || ' | ' || n_nationkey || ' |', chr(10) ORDER BY n_nationkey) AS md
FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name
"""
)
def markdown_table(table):
    rows = F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda s: F.array(s["n_name"], s["n_nationkey"].cast("string")))
    joined = table("nation").join(F.broadcast(table("region")), F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(rows.alias("rows"))
    return joined.select("r_name", F.array_join(T.markdown_table(F.array(F.lit("nation"), F.lit("key")), F.col("rows")), "\n").alias("md"))


@query(
    r"""
SELECT p_partkey, regexp_replace(trim(translate(regexp_replace(p_name, '[(),]', '', 'g'), '/.', '__')), '\s+', '_', 'g') || '__' || p_partkey AS slug FROM part
"""
)
def slug(table):
    return table("part").select("p_partkey", T.slug(F.col("p_name"), F.col("p_partkey").cast("string")).alias("slug"))


@query(
    r"""
SELECT page_id, CASE WHEN k = '' THEN 'Unknown' WHEN regexp_matches(k, '^[0-9]') THEN 'X' || upper(k[1]) || lower(k[2:]) ELSE upper(k[1]) || lower(k[2:]) END AS ident
FROM (SELECT page_id, regexp_replace(replace(regexp_replace(url, '^https?://', ''), '.', '_'), '[^A-Za-z0-9_]', '', 'g') AS k FROM pages)
"""
)
def ident(table):
    return table("pages").select("page_id", T.identifier(F.regexp_replace("url", "^https?://", "")).alias("ident"))


@query(
    """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
m AS (SELECT doc_id, l, least(40, coalesce(list_min([len(x) - len(ltrim(x)) FOR x IN l IF trim(x) <> '']), 0)) AS n FROM l)
SELECT doc_id, CAST(n AS BIGINT) AS indent, array_to_string([substr(x, CAST(n AS BIGINT) + 1) FOR x IN l], chr(10)) AS plain FROM m
"""
)
def dedent(table):
    lines = table("documents").select("doc_id", F.split("text", "\n").alias("l"))
    lines = lines.withColumn("indent", T.indent(F.col("l")))
    return lines.select("doc_id", long("indent").alias("indent"), F.array_join(T.dedent(F.col("l"), F.col("indent")), "\n").alias("plain"))


@query(
    r"""
WITH t AS (SELECT event_type, unnest(regexp_extract_all(props, '"[a-z_]+"|[{}:,]')) AS token FROM events)
SELECT event_type, count(*) AS n, CAST(count(DISTINCT token) AS BIGINT) AS kinds, string_agg(DISTINCT token, ' ' ORDER BY token) AS tokens FROM t GROUP BY event_type
"""
)
def token_sets(table):
    """Distinct keys and signs of the whole props."""
    tokens = table("events").select("event_type", F.explode(F.regexp_extract_all("props", F.lit('"[a-z_]+"|[{}:,]'), 0)).alias("token"))
    each = tokens.groupBy("event_type", "token").agg(F.count("*").alias("k"))
    return each.groupBy("event_type").agg(long(F.sum("k")).alias("n"), count().alias("kinds"), F.array_join(F.array_sort(F.collect_list("token")), " ").alias("tokens"))


@query("SELECT p_partkey, CASE WHEN p_size = 1 THEN '31' ELSE '31:' || greatest(0, 31 - (p_size - 1)) END AS label FROM part")
def bit_labels(table):
    return table("part").select("p_partkey", T.bit_label(F.lit(31), F.col("p_size")).alias("label"))


@query(
    """
WITH named(code, glyph) AS (VALUES (2, '≠'), (3, '≥'), (4, '≤'), (5, '*'), (6, '∞'), (7, 'π'), (8, 'Š'), (9, 'ε'), (10, 'Σ'), (11, 'σ'), (12, '√'), (130, ','), (135, '⁄'),
  (133, '…'), (138, '-'), (149, '-'), (150, '-'), (151, '-'), (143, '≠'), (145, chr(39)), (146, chr(39)), (147, '"'), (148, '"'), (153, '™'), (171, '<<'), (174, '®'),
  (177, '±'), (178, '²'), (179, '³'), (181, 'μ'), (188, '¼'), (189, '½'), (215, '×'), (247, '÷'))
SELECT event_id, coalesce(glyph, CASE WHEN event_id % 256 BETWEEN 32 AND 126 THEN chr(CAST(event_id % 256 AS INTEGER)) ELSE chr(65533) END) AS glyph
FROM events LEFT JOIN named ON code = event_id % 256
"""
)
def byte_glyphs(table):
    """Every byte as text."""
    return table("events").select("event_id", T.byte_to_text((F.col("event_id") % 256).cast("int")).alias("glyph"))


# -- the engine's own operators over made-up rows ---------------------------
#
# A row of a table stands for a title, an expression, a body or a line; the
# SQL says what the operator has to make of it.

_JCC = """'JA', 'JAE', 'JB', 'JBE', 'JC', 'JCXZ', 'JECXZ', 'JRCXZ', 'JE', 'JG', 'JGE', 'JL', 'JLE', 'JNA', 'JNAE', 'JNB', 'JNBE', 'JNC', 'JNE', 'JNG', 'JNGE',
  'JNL', 'JNLE', 'JNO', 'JNP', 'JNS', 'JNZ', 'JO', 'JP', 'JPE', 'JPO', 'JS', 'JZ'"""


@query(
    f"""
WITH t AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN [p_type || 'XPS', p_type || p_size || 'PS'] WHEN 1 THEN [p_type, p_type || 'S']
  WHEN 2 THEN [{_JCC}] ELSE [p_type || 'A', p_type || 'B'] END AS names FROM part)
SELECT p_partkey, CAST(unnest(range(len(names))) AS BIGINT) AS place, unnest(names) AS name FROM t
"""
)
def name_expansion(table):
    """Bracket groups, alternatives, short forms and Jcc."""
    kind, t = F.col("p_partkey") % 4, F.col("p_type")
    grouped = F.concat(t, F.lit("[X, "), F.col("p_size").cast("string"), F.lit("]PS"))
    title = T.first_of((kind == 0, grouped), (kind == 1, F.concat(t, F.lit("/"), t, F.lit("S"))), (kind == 2, "Jcc"), default=F.concat(t, F.lit("A/B")))
    return table("part").select("p_partkey", F.posexplode(names.names(title)).alias("place", "name")).select("p_partkey", long("place").alias("place"), "name")


#: Expressions with a number (#): precedence, calls, slices, comments, numbers, and what is unknown or ends early.
_EXPRESSIONS = [
    "DEST + #", "DEST - SRC - #", "DEST * SRC << #", "DEST / # + SRC2", "SRC MOD #", "SRC mod # * 2", "DEST OR SRC AND #", "DEST bitwiseOR SRC bitwiseXOR #",
    "DEST or SRC xor # and SRC3", "DEST XOR # XOR SRC", "(DEST + SRC) * #", "((#))", "NOT DEST + #", "not (DEST AND #)", "- SRC - - #", "DEST SHL # SHR 1",
    "SRC >> # << 2", "SignExtend(SRC)", "ZeroExtend(SRC + #, 64) + 1", "ZERO_EXTEND(#)", "ZERO_EXTEND_TO_512(SRC)", "Abs(DEST - #)", "Neg(#) * Abs(SRC)", "Foo(#)",
    "SignExtend()", "EAX[7:0] + #", "XMM3[#] AND RIP", "imm8 + imm# + OperandSize", "0#H + 0x#", "00# + tmp# + TMP64", "(* DEST *) # (* end", "DEST + ; #", "(DEST + #",
    "SRC # + 1", "SignExtend((DEST + #) SRC) - ZF", "", "~ # & DEST",
]


@query(
    """
WITH irs(n, ir) AS (VALUES
  (0, 'b::add(o1(), c(#))'), (1, 'b::sub(b::sub(o1(), o2()), c(#))'), (2, 'b::mul(o1(), b::shl(o2(), c(#)))'), (3, 'b::add(b::unsigned_div(o1(), c(#)), o3())'),
  (4, 'b::unsigned_rem(o2(), c(#))'), (5, 'b::mul(b::unsigned_rem(o2(), c(#)), c(2))'), (6, 'b::or(o1(), b::and(o2(), c(#)))'), (7, 'b::or(o1(), b::xor(o2(), c(#)))'),
  (8, 'b::or(o1(), b::xor(o2(), b::and(c(#), o4())))'), (9, 'b::xor(b::xor(o1(), c(#)), o2())'), (10, 'b::mul(b::add(o1(), o2()), c(#))'), (11, 'c(#)'),
  (12, 'b::add(u::not(o1()), c(#))'), (13, 'u::not(b::and(o1(), c(#)))'), (14, 'b::sub(u::neg(o2()), u::neg(c(#)))'), (15, 'b::shr(b::shl(o1(), c(#)), c(1))'),
  (16, 'b::shl(b::shr(o2(), c(#)), c(2))'), (17, 'u::sign_extend(o2())'), (18, 'b::add(u::zero_extend(b::add(o2(), c(#))), c(1))'), (19, 'u::zero_extend(c(#))'),
  (20, 'u::zero_extend(o2())'), (21, 'b::sub(o1(), c(#))'), (22, 'b::mul(u::neg(c(#)), o2())'), (23, 'unknown_data()'), (24, 'u::sign_extend(o1())'),
  (25, 'b::add(eax.clone(), c(#))'), (26, 'b::and(xmm3.clone(), rip.clone())'), (27, 'b::add(b::add(o2(), o2()), architecture_bit_size())'), (28, 'b::add(c(0x0#), c(0))'),
  (29, 'b::add(b::add(c(#), unknown_data()), tmp64.clone())'), (30, 'c(#)'), (31, 'b::add(o1(), unknown_data())'), (32, 'b::add(o1(), c(#))'), (33, 'o2()'),
  (34, 'b::sub(u::sign_extend(b::add(o1(), c(#))), zf.clone())'), (35, 'unknown_data()'), (36, 'c(#)'))
SELECT l_orderkey, l_linenumber, l_partkey, n, replace(ir, '#', CAST(l_partkey AS VARCHAR)) AS ir
FROM lineitem JOIN irs ON n = (l_orderkey + 7 * l_linenumber) % 37
"""
)
def expr_compile(table):
    """Expressions compiled on the JVM, one shape of 37 a row; texts that differ in numbers alone are compiled once."""
    n = ((F.col("l_orderkey") + 7 * F.col("l_linenumber")) % len(_EXPRESSIONS)).cast("int")
    text = F.replace(F.element_at(F.array(*map(F.lit, _EXPRESSIONS)), n + 1), F.lit("#"), F.col("l_partkey").cast("string"))
    made = table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", n.alias("n"), text.alias("text"))
    return forms.compiled(made, "text", "ir", pseudocode.EXPRESSION).drop("text")


#: Operations with a number (#) of either grammar: every statement, gate and branch, and every rule of the ARM table.
_OPERATIONS = [
    "DEST := SRC + #;", "temp := SRC;\nDEST := temp * #", "tmp8 := #\ntmpx := tmp8 + SRC2\nEAX := tmpx", "EAX[7:0] := imm8;", "XMM1 := #", "Foo := Foo(#)", "#UD",
    "(* only # *)", "The text #\nDEST := #\nNote that", "Flags Affected\nDEST := #", "IF DEST = # THEN DEST := SRC; FI;", "IF SRC > #\nTHEN\nDEST := SRC;\nFI;",
    "IF SRC < # THEN DEST := SRC; FI;", "IF SRC >= # THEN DEST := SRC; FI;", "IF DEST = # THEN DEST := SRC; ELSE DEST := #; FI;",
    "IF 64-bit mode THEN #UD; ELSE DEST := SRC - #; FI;", "IF OperandSize = # THEN DEST := SRC; ELSE DEST := #; FI;", "IF Foo THEN DEST := #; FI;",
    "IF DEST = # THEN IF SRC = 1 THEN DEST := SRC; FI; FI;", "FOR j := 0 to #\nDEST := SRC", 'DEST := #;\n' * 6, 'DEST := #;\n' * 5,
    'IF DEST = # THEN\n' + 'DEST := #;\n' * 30 + 'FI;', "",
]
_ARM_OPERATIONS = [
    "X[d] = #", "W[d] = #", "V[d] = #", "X[n] = #", "W[n] = #", "V[n] = #", "X[m] = #", "W[m] = #", "V[m] = #", "X[t] = #", "W[t] = #", "V[t] = #", "X[s] = #",
    "W[s] = #", "X[a] = #", "V[a] = #", "X[d] = X[n]", "X[d] = W[n]", "X[d] = V[n]", "X[d] = X[m]", "X[d] = W[m]", "X[d] = V[m]", "X[d] = X[t]", "X[d] = W[t]",
    "X[d] = V[t]", "X[d] = X[s]", "X[d] = W[s]", "X[d] = X[a]", "X[d] = V[a]", "X[d] = PSTATE.N", "X[d] = PSTATE.Z", "X[d] = PSTATE.C", "X[d] = PSTATE.V",
    "PSTATE.N = X[n]<#:0>", "PSTATE.Z = X[n]<#:0>", "PSTATE.C = X[n]<#:0>", "PSTATE.V = X[n]<#:0>", "X[d] = NOT(X[n] + #)", "X[d] = ZeroExtend(X[n], #)",
    "X[d] = SignExtend(X[n])", "X[d] = Abs(X[n] - #)", "X[d] = UInt(X[n]) * SInt(#)", "X[d] = 0x1F", "X[d] = X[n]<#:0>", "X[d]<31:0> = X[n] EOR #", "X[d] = X[n] AND #",
    "X[d] = X[n] OR #", "X[d] = X[n] + # EOR 1", "X[d] = X[n] - # - 1", "X[d] = X[n] * #", "X[d] = X[n] DIV #", "X[d] = X[n] MOD #",
    "X[d] = AddWithCarry(X[n], NOT(X[m]), PSTATE.C)", "X[d] = AddWithCarry(X[n] + #, 1, 0)", "X[d] = ShiftReg(m, LSL, #)", "X[d] = ShiftReg(#, LSL, 1)",
    "X[d] = (X[n] - #)", "X[d] = Foo(#)", "(result, nzcv) = AddWithCarry(X[n], #, 0);\nX[d] = result;\nPSTATE.C = nzcv<1:1>;", "operand2 = X[m];\nX[d] = operand2 + #;",
    "PSTATE.X = #", "foo", "integer d = #;\nbits(64) op;\nbit b\nCheckFPEnabled64();\n// bits(4) nzcv\nX[d] = X[n] + #;", "if a == # then X[d] = 1;\nX[d] = X[n] + #;",
    "if a then\nX[d] = 1;\nelse\nX[d] = #;\nend", "if a then X[d] = 1;\nelse\nX[d] = 2;\nfi\nX[d] = #;", "for i = 0 to #\nX[d] = 1", "while i < #\nX[d] = 1",
    "X[d] = Elem[x, #]", "X[d] = Mem[x, #]", "X[d] = AESSub(X[n], #)", 'X[d] = X[n] + #;\n' * 10, 'X[d] = X[n] + #;\n' * 11,
    'if a then b = c;\n' + 'X[d] = X[n] + #;\n' * 14, 'if a then b = c;\n' + 'X[d] = X[n] + #;\n' * 15, "",
]


@query(
    """
WITH x86(k, lines) AS (VALUES
  (0, '    let stmt_0 = assign(b::add(o2(), c(#)), o1(), o1_size());|    [stmt_0].into()'),
  (1, '    let v_0 = o2();|    let stmt_1 = assign(b::mul(v_0, c(#)), o1(), o1_size());|    [stmt_1].into()'),
  (2, '    let v_0 = c(#);|    let v_1 = b::add(v_0, o3());|    let stmt_2 = assign(v_1, eax.clone(), size_relative(eax.clone()));|    [stmt_2].into()'),
  (3, '    let stmt_0 = assign(o2(), eax.clone(), size_relative(eax.clone()));|    [stmt_0].into()'),
  (4, '    let stmt_0 = assign(c(#), xmm1.clone(), o1_size());|    [stmt_0].into()'), (5, '    let stmt_0 = assign(unknown_data(), o1(), o1_size());|    [stmt_0].into()'),
  (6, '    [exception("#UD")].into()'), (7, NULL), (8, '    let stmt_0 = assign(c(#), o1(), o1_size());|    [stmt_0].into()'),
  (9, '    let stmt_0 = assign(c(#), o1(), o1_size());|    [stmt_0].into()'),
  (10, '    let stmt_0 = assign(o2(), o1(), o1_size());|    let cond = condition(b::equal(o1(), c(#), o1_size()), [stmt_0], []);|    [cond].into()'),
  (11, '    let stmt_0 = assign(o2(), o1(), o1_size());|    let cond = condition(b::signed_less(c(#), o2(), o1_size()), [stmt_0], []);|    [cond].into()'),
  (12, '    let stmt_0 = assign(o2(), o1(), o1_size());|    let cond = condition(b::signed_less(o2(), c(#), o1_size()), [stmt_0], []);|    [cond].into()'),
  (13, '    let stmt_0 = assign(o2(), o1(), o1_size());|    let cond = condition(b::equal(o2(), c(#), o1_size()), [stmt_0], []);|    [cond].into()'),
  (14, '    let stmt_0 = assign(c(#), o1(), o1_size());|    [stmt_0].into()'), (15, '    let stmt_0 = assign(b::sub(o2(), c(#)), o1(), o1_size());|    [stmt_0].into()'),
  (16, '    let stmt_0 = assign(o2(), o1(), o1_size());|    [stmt_0].into()'), (17, NULL),
  (18, '    let stmt_0 = assign(o2(), o1(), o1_size());|    let cond = condition(b::equal(o1(), c(#), o1_size()), [stmt_0], []);|    [cond].into()'), (19, NULL), (20, NULL),
  (21, array_to_string(['    let stmt_' || k || ' = assign(c(#), o1(), o1_size());' FOR k IN range(5)], '|') || '|    [' || array_to_string(['stmt_' || k FOR k IN range(5)], ', ') || '].into()'),
  (22, NULL), (23, NULL)),
arm(m, lines) AS (VALUES
  (0, '    let stmt_0 = assign(c(#), o1(), o1_size());|    [stmt_0].into()'), (1, '    let stmt_0 = assign(c(#), o1(), o1_size());|    [stmt_0].into()'),
  (2, '    let stmt_0 = assign(c(#), o1(), o1_size());|    [stmt_0].into()'), (3, '    let stmt_0 = assign(c(#), o2(), o2_size());|    [stmt_0].into()'),
  (4, '    let stmt_0 = assign(c(#), o2(), o2_size());|    [stmt_0].into()'), (5, '    let stmt_0 = assign(c(#), o2(), o2_size());|    [stmt_0].into()'),
  (6, '    let stmt_0 = assign(c(#), o3(), o3_size());|    [stmt_0].into()'), (7, '    let stmt_0 = assign(c(#), o3(), o3_size());|    [stmt_0].into()'),
  (8, '    let stmt_0 = assign(c(#), o3(), o3_size());|    [stmt_0].into()'), (9, '    let stmt_0 = assign(c(#), o1(), o1_size());|    [stmt_0].into()'),
  (10, '    let stmt_0 = assign(c(#), o1(), o1_size());|    [stmt_0].into()'), (11, '    let stmt_0 = assign(c(#), o1(), o1_size());|    [stmt_0].into()'),
  (12, '    let stmt_0 = assign(c(#), o2(), o2_size());|    [stmt_0].into()'), (13, '    let stmt_0 = assign(c(#), o2(), o2_size());|    [stmt_0].into()'),
  (14, '    let stmt_0 = assign(c(#), o3(), o3_size());|    [stmt_0].into()'), (15, '    let stmt_0 = assign(c(#), o3(), o3_size());|    [stmt_0].into()'),
  (16, '    let stmt_0 = assign(o2(), o1(), o1_size());|    [stmt_0].into()'), (17, '    let stmt_0 = assign(o2(), o1(), o1_size());|    [stmt_0].into()'),
  (18, '    let stmt_0 = assign(o2(), o1(), o1_size());|    [stmt_0].into()'), (19, '    let stmt_0 = assign(o3(), o1(), o1_size());|    [stmt_0].into()'),
  (20, '    let stmt_0 = assign(o3(), o1(), o1_size());|    [stmt_0].into()'), (21, '    let stmt_0 = assign(o3(), o1(), o1_size());|    [stmt_0].into()'),
  (22, '    let stmt_0 = assign(o1(), o1(), o1_size());|    [stmt_0].into()'), (23, '    let stmt_0 = assign(o1(), o1(), o1_size());|    [stmt_0].into()'),
  (24, '    let stmt_0 = assign(o1(), o1(), o1_size());|    [stmt_0].into()'), (25, '    let stmt_0 = assign(o2(), o1(), o1_size());|    [stmt_0].into()'),
  (26, '    let stmt_0 = assign(o2(), o1(), o1_size());|    [stmt_0].into()'), (27, '    let stmt_0 = assign(o3(), o1(), o1_size());|    [stmt_0].into()'),
  (28, '    let stmt_0 = assign(o3(), o1(), o1_size());|    [stmt_0].into()'), (29, '    let stmt_0 = assign(pstate_n.clone(), o1(), o1_size());|    [stmt_0].into()'),
  (30, '    let stmt_0 = assign(pstate_z.clone(), o1(), o1_size());|    [stmt_0].into()'),
  (31, '    let stmt_0 = assign(pstate_c.clone(), o1(), o1_size());|    [stmt_0].into()'),
  (32, '    let stmt_0 = assign(pstate_v.clone(), o1(), o1_size());|    [stmt_0].into()'),
  (33, '    let stmt_0 = assign(o2(), pstate_n.clone(), size_relative(pstate_n.clone()));|    [stmt_0].into()'),
  (34, '    let stmt_0 = assign(o2(), pstate_z.clone(), size_relative(pstate_z.clone()));|    [stmt_0].into()'),
  (35, '    let stmt_0 = assign(o2(), pstate_c.clone(), size_relative(pstate_c.clone()));|    [stmt_0].into()'),
  (36, '    let stmt_0 = assign(o2(), pstate_v.clone(), size_relative(pstate_v.clone()));|    [stmt_0].into()'),
  (37, '    let stmt_0 = assign(u::not(b::add(o2(), c(#))), o1(), o1_size());|    [stmt_0].into()'),
  (38, '    let stmt_0 = assign(o2(), o1(), o1_size());|    [stmt_0].into()'), (39, '    let stmt_0 = assign(o2(), o1(), o1_size());|    [stmt_0].into()'),
  (40, '    let stmt_0 = assign(b::sub(o2(), c(#)), o1(), o1_size());|    [stmt_0].into()'),
  (41, '    let stmt_0 = assign(b::mul(unknown_data(), unknown_data()), o1(), o1_size());|    [stmt_0].into()'),
  (42, '    let stmt_0 = assign(c(0x1F), o1(), o1_size());|    [stmt_0].into()'), (43, '    let stmt_0 = assign(o2(), o1(), o1_size());|    [stmt_0].into()'),
  (44, '    let stmt_0 = assign(b::xor(o2(), c(#)), o1(), o1_size());|    [stmt_0].into()'),
  (45, '    let stmt_0 = assign(b::and(o2(), c(#)), o1(), o1_size());|    [stmt_0].into()'),
  (46, '    let stmt_0 = assign(b::or(o2(), c(#)), o1(), o1_size());|    [stmt_0].into()'),
  (47, '    let stmt_0 = assign(b::xor(b::add(o2(), c(#)), c(1)), o1(), o1_size());|    [stmt_0].into()'),
  (48, '    let stmt_0 = assign(b::sub(o2(), b::sub(c(#), c(1))), o1(), o1_size());|    [stmt_0].into()'),
  (49, '    let stmt_0 = assign(b::mul(o2(), c(#)), o1(), o1_size());|    [stmt_0].into()'),
  (50, '    let stmt_0 = assign(b::unsigned_div(o2(), c(#)), o1(), o1_size());|    [stmt_0].into()'),
  (51, '    let stmt_0 = assign(b::unsigned_mod(o2(), c(#)), o1(), o1_size());|    [stmt_0].into()'),
  (52, '    let stmt_0 = assign(b::add(b::add(o2(), u::not(o3())), pstate_c.clone()), o1(), o1_size());|    [stmt_0].into()'),
  (53, '    let stmt_0 = assign(b::add(unknown_data(), unknown_data()), o1(), o1_size());|    [stmt_0].into()'),
  (54, '    let stmt_0 = assign(o3(), o1(), o1_size());|    [stmt_0].into()'), (55, '    let stmt_0 = assign(o2(), o1(), o1_size());|    [stmt_0].into()'),
  (56, '    let stmt_0 = assign(b::sub(unknown_data(), unknown_data()), o1(), o1_size());|    [stmt_0].into()'),
  (57, '    let stmt_0 = assign(unknown_data(), o1(), o1_size());|    [stmt_0].into()'),
  (58, '    let v_0 = b::add(b::add(o2(), c(#)), c(0));|    let stmt_1 = assign(v_0.clone(), o1(), o1_size());|    let stmt_2 = assign(v_0.clone(), pstate_c.clone(), size_relative(pstate_c.clone()));|    [stmt_1, stmt_2].into()'),
  (59, '    let v_0 = o3();|    let stmt_1 = assign(b::add(v_0, c(#)), o1(), o1_size());|    [stmt_1].into()'), (60, NULL), (61, NULL),
  (62, '    let stmt_0 = assign(b::add(o2(), c(#)), o1(), o1_size());|    [stmt_0].into()'),
  (63, '    let stmt_0 = assign(b::add(o2(), c(#)), o1(), o1_size());|    [stmt_0].into()'), (64, '    let stmt_0 = assign(c(#), o1(), o1_size());|    [stmt_0].into()'),
  (65, '    let stmt_0 = assign(c(#), o1(), o1_size());|    [stmt_0].into()'), (66, NULL), (67, NULL), (68, NULL), (69, NULL), (70, NULL),
  (71, array_to_string(['    let stmt_' || k || ' = assign(b::add(o2(), c(#)), o1(), o1_size());' FOR k IN range(10)], '|') || '|    [' || array_to_string(['stmt_' || k FOR k IN range(10)], ', ') || '].into()'),
  (72, NULL),
  (73, array_to_string(['    let stmt_' || k || ' = assign(b::add(o2(), c(#)), o1(), o1_size());' FOR k IN range(14)], '|') || '|    [' || array_to_string(['stmt_' || k FOR k IN range(14)], ', ') || '].into()'),
  (74, NULL), (75, NULL))
SELECT o_orderkey, CASE WHEN k = 6 THEN x86.lines ELSE replace(replace(x86.lines, '#', CAST(o_custkey AS VARCHAR)), '|', chr(10)) END AS x86,
  replace(replace(arm.lines, '#', CAST(o_custkey AS VARCHAR)), '|', chr(10)) AS arm
FROM orders JOIN x86 ON k = o_orderkey % 24 JOIN arm ON m = o_orderkey % 76
"""
)
def operation_compile(table):
    """Operations of both grammars compiled on the JVM, 24 and 76 shapes; texts that differ in numbers alone are compiled once."""
    made = lambda texts: F.element_at(F.array(*map(F.lit, texts)), (F.col("o_orderkey") % len(texts)).cast("int") + 1)
    filled = lambda text: F.when(text.startswith("#"), text).otherwise(F.replace(text, F.lit("#"), F.col("o_custkey").cast("string")))
    texts = table("orders").select("o_orderkey", filled(made(_OPERATIONS)).alias("x86_text"), filled(made(_ARM_OPERATIONS)).alias("arm_text"))
    x86 = forms.compiled(texts, "x86_text", "x86", pseudocode.OPERATIONS["x86_64"])
    return forms.compiled(x86, "arm_text", "arm", pseudocode.OPERATIONS["arm"]).drop("x86_text", "arm_text")


def _bodies(table) -> DataFrame:
    operator = F.when(F.col("l_returnflag") == "A", "add").when(F.col("l_returnflag") == "N", "sub").otherwise("xor")
    end = F.when(F.col("l_linestatus") == "O", "[x, jump_by_call(zf)]").otherwise("halt")
    body = F.concat(F.lit("let x = assign(b::"), operator, F.lit("(o1(), rax.clone()), o"), F.col("l_linenumber").cast("string"), F.lit("(), o1_size()); "), end, F.lit(".into()"))
    return table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", body.alias("body"))


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, 'b::' || CASE l_returnflag WHEN 'A' THEN 'add' WHEN 'N' THEN 'sub' ELSE 'xor' END AS operators,
  CASE WHEN l_linestatus = 'O' THEN 'assign jump_by_call' ELSE 'assign halt' END AS statements, CASE WHEN l_linestatus = 'O' THEN 'zf' ELSE '' END AS flags,
  CASE WHEN l_linenumber BETWEEN 2 AND 4 THEN 'o1() o' || l_linenumber || '()' ELSE 'o1()' END AS operands, 'rax' AS registers
FROM lineitem
"""
)
def ir_signatures(table):
    """The sets of operators, statements, flags, operands and registers of bodies."""
    signed = _bodies(table).withColumn("s", validate.signature(F.col("body")))
    return signed.select("l_orderkey", "l_linenumber", "l_partkey", *(F.array_join(F.col("s")[part], " ").alias(part) for part in ("operators", "statements", "flags", "operands", "registers")))


_EXPECTED = "assign(b::add(o1(), o2()), o1(), o1_size()) zf [x].into()"


@query(
    """
WITH m AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag <> 'A' AS other, l_linestatus <> 'O' AS bare, l_linenumber <> 2 AS lacks, CASE l_returnflag WHEN 'N' THEN 'sub' ELSE 'xor' END AS op
  FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey,
  concat_ws('; ', CASE WHEN other THEN 'missing operators: b::add' END, CASE WHEN other THEN 'extra operators: b::' || op END, CASE WHEN bare THEN 'missing flags: zf' END,
    CASE WHEN lacks THEN 'missing operands: o2()' END) AS differences,
  CASE WHEN other OR bare THEN 'failure' WHEN lacks THEN 'warning' ELSE 'passed' END AS severity
FROM m
"""
)
def ir_differences(table):
    """What bodies lack of an expected one, and the severity."""
    found = validate.signature_difference(validate.signature(F.col("body")), validate.signature(F.lit(_EXPECTED)))
    told = _bodies(table).withColumn("m", found)
    return told.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join("m", "; ").alias("differences"), validate.severity(F.col("m")).alias("severity"))


@query(
    """
SELECT p_partkey, CASE p_partkey % 6 WHEN 5 THEN 'skipped' WHEN 4 THEN 'exception' ELSE 'real_ir' END AS status,
  CASE p_partkey % 6 WHEN 0 THEN 'template: add' WHEN 1 THEN 'conditional jump: ja' WHEN 2 THEN 'SIMD pattern: vaddps' WHEN 3 THEN 'pseudocode translated'
    WHEN 4 THEN 'fallback: pseudocode too complex or untranslatable' ELSE 'no operation pseudocode' END AS reason,
  CASE p_partkey % 6 WHEN 1 THEN '    [jcc(cond)].into()' WHEN 2 THEN '    [assignment].into()' WHEN 3 THEN '    [stmt_0].into()' WHEN 4 THEN '    [exception("qq' || p_partkey || '")].into()' END AS last
FROM part
"""
)
def template_dispatch(table):
    """Exact template, condition code, pattern, compiler, fallback, and rows without pseudocode."""
    k, made = F.col("p_partkey") % 6, F.concat(F.lit("qq"), F.col("p_partkey").cast("string"))
    mnemonic = T.first_of((k == 0, "add"), (k == 1, "ja"), (k == 2, "vaddps"), default=made)
    operation = T.first_of((k == 5, " "), (k == 4, "FOR i := 0 to 3"), default="DEST := SRC << 1;")
    part = table("part").select("p_partkey", mnemonic.alias("mnemonic"), operation.alias("operation"))
    out = dispatch.generate(part, registry.templates(part.sparkSession), "x86_64")
    return out.select("p_partkey", "status", "reason", F.when(F.col("p_partkey") % 6 != 0, F.element_at("body", -1)).alias("last"))


_ROUTE = """SELECT l_suppkey % 4 AS range_id, l_orderkey AS page_no, row_number() OVER (PARTITION BY l_suppkey % 4, l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice, l_quantity, l_shipdate) AS seq,
  CASE WHEN l_partkey % 9 = 1 THEN 'ADD—Add' WHEN l_partkey % 9 = 2 THEN 'Description' WHEN l_partkey % 9 = 3 THEN 'Operation' WHEN l_partkey % 9 = 4 THEN 'Other Exceptions' ELSE 'line ' || l_partkey END AS text,
  CASE WHEN l_partkey % 9 = 1 THEN 12.0 ELSE 9.0 END AS font_scale FROM lineitem"""


@query(
    f"""
WITH l AS ({_ROUTE}), t AS (SELECT *, text = 'ADD—Add' AS is_title, CASE text WHEN 'Description' THEN 'Description' WHEN 'Operation' THEN 'Operation' WHEN 'Other Exceptions' THEN 'Exceptions' END AS heading FROM l),
r AS (SELECT *, greatest(1, sum(CAST(is_title AS INT)) OVER (PARTITION BY range_id ORDER BY page_no, seq)) AS instr_id FROM t)
SELECT CAST(range_id AS BIGINT) AS range_id, CAST(instr_id AS BIGINT) AS instr_id, coalesce(section, '') AS section, coalesce(name, '') AS name, count(*) AS n, CAST(max(segment) AS BIGINT) AS segments FROM (
  SELECT *, last_value(heading IGNORE NULLS) OVER w AS section, last_value(CASE WHEN heading IS NOT NULL THEN text END IGNORE NULLS) OVER w AS name, count(heading) OVER w AS segment
  FROM r WINDOW w AS (PARTITION BY range_id, instr_id ORDER BY page_no, seq)) GROUP BY ALL
"""
)
def section_routing(table):
    """Records and sections over pages."""
    k, w = F.col("l_partkey") % 9, Window.partitionBy("range_id", "l_orderkey").orderBy("l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_shipdate")
    text = T.first_of((k == 1, "ADD—Add"), (k == 2, "Description"), (k == 3, "Operation"), (k == 4, "Other Exceptions"), default=F.concat(F.lit("line "), F.col("l_partkey").cast("string")))
    lines = table("lineitem").withColumn("range_id", F.col("l_suppkey") % 4)
    lines = lines.select("range_id", F.col("l_orderkey").alias("page_no"), F.row_number().over(w).alias("seq"), text.alias("text"), F.when(k == 1, 12.0).otherwise(9.0).alias("font_scale"))
    routed = sections.routed(lines).groupBy("range_id", "instr_id", F.coalesce("section", F.lit("")).alias("section"), F.coalesce("section_name", F.lit("")).alias("name"))
    counted = routed.agg(count().alias("n"), long(F.max("segment")).alias("segments"))
    return counted.select(long("range_id").alias("range_id"), long("instr_id").alias("instr_id"), "section", "name", "n", "segments")


@query(
    f"""
WITH l AS ({_ROUTE}), t AS (SELECT *, text = 'ADD—Add' AS is_title, CASE text WHEN 'Description' THEN 'Description' WHEN 'Operation' THEN 'Operation' WHEN 'Other Exceptions' THEN 'Exceptions' END AS heading FROM l),
n AS (SELECT *, sum(CAST(is_title AS INT)) OVER (PARTITION BY range_id ORDER BY page_no, seq) AS titles FROM t),
r AS (SELECT *, greatest(1, titles) AS instr_id FROM n),
s AS (SELECT *, last_value(heading IGNORE NULLS) OVER w AS section, count(heading) OVER w AS segment FROM r WINDOW w AS (PARTITION BY range_id, instr_id ORDER BY page_no, seq)),
b AS (SELECT range_id, instr_id, page_no, seq, text, segment, coalesce(section, 'Description') AS section FROM s WHERE heading IS NULL AND NOT is_title AND (section IS NOT NULL OR titles > 0)),
o AS (SELECT range_id, instr_id, string_agg(text, chr(10) ORDER BY page_no, seq) AS operation FROM b WHERE section = 'Operation'
  AND (range_id, instr_id, segment) IN (SELECT (range_id, instr_id, max(segment)) FROM b WHERE section = 'Operation' GROUP BY range_id, instr_id) GROUP BY ALL)
SELECT CAST(range_id AS BIGINT) AS range_id, CAST(instr_id AS BIGINT) AS instr_id, CASE WHEN max(titles) > 0 THEN 'ADD' ELSE '' END AS title,
  coalesce((SELECT string_agg(text, '|' ORDER BY page_no, seq) FROM b WHERE b.range_id = r.range_id AND b.instr_id = r.instr_id AND section = 'Description'), '') AS description,
  coalesce((SELECT string_agg(text, '|' ORDER BY page_no, seq) FROM b WHERE b.range_id = r.range_id AND b.instr_id = r.instr_id AND section = 'Exceptions'), '') AS exceptions,
  coalesce((SELECT operation FROM o WHERE o.range_id = r.range_id AND o.instr_id = r.instr_id), '') AS operation
FROM r GROUP BY r.range_id, r.instr_id
"""
)
def record_sections(table):
    """Whole records of routed lines: lines before the first heading are description, and the last operation stays."""
    k, w = F.col("l_partkey") % 9, Window.partitionBy("range_id", "l_orderkey").orderBy("l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_shipdate")
    text = T.first_of((k == 1, "ADD—Add"), (k == 2, "Description"), (k == 3, "Operation"), (k == 4, "Other Exceptions"), default=F.concat(F.lit("line "), F.col("l_partkey").cast("string")))
    lines = table("lineitem").withColumn("range_id", F.col("l_suppkey") % 4)
    lines = lines.select("range_id", F.col("l_orderkey").alias("page_no"), F.row_number().over(w).alias("seq"), text.alias("text"), F.when(k == 1, 12.0).otherwise(9.0).alias("font_scale"))
    joined = lambda c: F.coalesce(F.array_join(c, "|"), F.lit(""))
    parts = F.flatten(F.transform("exceptions", lambda e: e["lines"]))
    return sections.records(sections.routed(lines)).select(
        long("range_id").alias("range_id"), long("instr_id").alias("instr_id"), "title", joined(F.col("description")).alias("description"), joined(parts).alias("exceptions"), "operation"
    )


_GRID = "SELECT p_partkey % 50 AS page_no, p_size % 3 AS group_id, p_partkey AS cell_id, p_size AS x0, p_partkey % 40 AS y0, p_size + 6 AS x1, p_partkey % 40 + 9 AS y1 FROM part"


@query(
    f"""
WITH c AS ({_GRID}), p AS (SELECT event_id, user_id % 50 AS page_no, CAST(value AS FLOAT) AS cx, CAST(event_id % 50 AS FLOAT) AS cy FROM events)
SELECT event_id, CAST(group_id AS BIGINT) AS group_id, CAST(min(cell_id) AS BIGINT) AS cell_id FROM p JOIN c ON p.page_no = c.page_no AND cx BETWEEN x0 - 1 AND x1 + 1 AND cy BETWEEN y0 - 1 AND y1 + 1 GROUP BY ALL
"""
)
def cell_glyphs(table):
    """The first cell of each group of a page that holds a glyph's centre."""
    f = lambda c: c.cast("float")
    size, row = F.col("p_size"), F.col("p_partkey") % 40
    cells = table("part").select((F.col("p_partkey") % 50).alias("page_no"), (size % 3).alias("group_id"), F.col("p_partkey").alias("cell_id"), f(size).alias("x0"), f(row).alias("y0"), f(size + 6).alias("x1"), f(row + 9).alias("y1"))
    x, y = f(F.col("value")), f(F.col("event_id") % 50)
    glyph = table("events").select("event_id", (F.col("user_id") % 50).alias("page_no"), x.alias("x0"), y.alias("y0"), x.alias("x1"), y.alias("y1"))
    return tables.glyphs_in_cells(glyph, cells, ["event_id"]).select("event_id", long("group_id").alias("group_id"), long("cell_id").alias("cell_id"))


@query(
    """
WITH h AS (SELECT p_partkey % 100 AS page_no, p_partkey AS seq, p_size AS cy, CASE WHEN p_partkey % 3 = 0 THEN 'Instruction' WHEN p_partkey % 3 = 1 THEN upper(p_type) ELSE 'Instruction' END AS heading, p_partkey % 7 > 0 AS sized FROM part),
t AS (SELECT c_custkey % 100 AS page_no, c_custkey AS table_id, c_custkey % 50 AS top FROM customer)
SELECT table_id, heading FROM (SELECT t.table_id, h.heading, row_number() OVER (PARTITION BY t.page_no, t.table_id ORDER BY h.cy - t.top, h.seq) AS r
  FROM t LEFT JOIN h ON t.page_no = h.page_no AND h.cy > t.top AND h.sized) WHERE r = 1
"""
)
def table_headings(table):
    """The nearest title or heading above each table."""
    key, f = F.col("p_partkey"), lambda c: c.cast("float")
    text = T.first_of((key % 3 == 0, "ADD—Add"), (key % 3 == 1, F.upper("p_type")), default=" Opcode/Instruction ")
    size = T.first_of((key % 7 == 0, 9.0), (key % 3 == 0, 12.0), default=10.0)
    lines = table("part").select((key % 100).alias("page_no"), key.alias("seq"), text.alias("text"), size.alias("font_scale"), f(F.col("p_size")).alias("y0"), f(F.col("p_size")).alias("y1"))
    made = table("customer").select((F.col("c_custkey") % 100).alias("page_no"), F.col("c_custkey").alias("table_id"), f(F.col("c_custkey") % 50).alias("top"))
    return sections.table_heading(made, lines).select("table_id", "heading")


@query(
    """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN '' ELSE 'ADDPD xmm' || o_custkey || ', m128=Adds ' || o_orderstatus END AS variants FROM orders
"""
)
def opcode_variants(table):
    """Mnemonics and descriptions of opcode tables, of separate and of merged columns."""
    k, key = F.col("o_orderkey") % 3, F.col("o_custkey").cast("string")
    mnemonic, told = F.concat(F.lit("ADDPD xmm"), key, F.lit(", m128")), F.concat(F.lit("Adds "), F.col("o_orderstatus"))
    merged = F.array(F.array(F.concat(F.lit("NP 66 0F 58 /r ib "), mnemonic), told), F.array(F.lit(""), told))
    apart = F.array(F.array(F.lit("0F"), mnemonic, told), F.array(F.lit("0F"), mnemonic, F.lit(" ")))
    heads = lambda *x: F.array(*map(F.lit, x))
    headers = T.first_of((k == 0, heads("Opcode/ Instruction", "Description")), (k == 1, heads("Opcode", "Instruction", "Description")), default=heads("Instruction Operand", "Description"))
    rows = F.when(k == 1, apart).otherwise(merged)
    shown = F.transform(T.variants(headers, rows), lambda v: F.concat(v["mnemonic"], F.lit("="), v["description"]))
    return table("orders").select("o_orderkey", F.array_join(shown, ";").alias("variants"))


@query(
    """
WITH f AS (SELECT CASE WHEN p_size % 2 = 0 THEN 'arm' ELSE 'x86_64' END AS arch, CASE p_partkey % 5 WHEN 0 THEN 'skipped' WHEN 1 THEN 'exception' ELSE 'real_ir' END AS status FROM part),
c AS (SELECT arch, count(*) AS n, count(*) FILTER (status <> 'skipped') AS with_operation, count(*) FILTER (status = 'real_ir') AS n_real_ir, count(*) FILTER (status = 'exception') AS n_exception, count(*) FILTER (status = 'skipped') AS n_skipped FROM f GROUP BY arch)
SELECT *, CAST(0 AS BIGINT) AS n_todo, CAST(100 * n_real_ir // with_operation AS BIGINT) AS percent_real_ir, CAST(100 * n_exception // with_operation AS BIGINT) AS percent_exception, CAST(0 AS BIGINT) AS percent_todo FROM c
"""
)
def generation_report(table):
    """Counts and whole percentages by status."""
    status = T.first_of((F.col("p_partkey") % 5 == 0, "skipped"), (F.col("p_partkey") % 5 == 1, "exception"), default="real_ir")
    return reports.generation(table("part").select(F.when(F.col("p_size") % 2 == 0, "arm").otherwise("x86_64").alias("arch"), status.alias("status")))


@query(
    r"""
WITH l AS (SELECT doc_id, unnest(string_split(x, chr(10))) AS line, unnest(range(len(string_split(x, chr(10))))) AS pos FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'enum X {' || chr(10) ELSE '' END || text AS x FROM documents)),
t AS (SELECT *, trim(line) AS t FROM l), p AS (SELECT *, NOT (starts_with(t, '///') OR t = '' OR starts_with(t, 'enum') OR t = '}') AS plain FROM t),
w AS (SELECT doc_id, bool_or(pos = 0 AND starts_with(line, 'enum ')) AS declared, count(*) FILTER (plain AND ends_with(t, ',')) AS variants, count(*) FILTER (starts_with(t, '/// #')) AS heads FROM p GROUP BY doc_id),
m AS (
  SELECT doc_id, CASE WHEN declared THEN [CASE WHEN variants = 0 THEN 'no enum variants found' END, CASE WHEN heads = 0 THEN 'no doc H1 headings found' END] ELSE ['doesn''t start with ''enum'' declaration'] END AS found, NULL AS pos FROM w
  UNION ALL SELECT p.doc_id, [CASE WHEN plain AND ends_with(t, ',') AND NOT regexp_matches(trim(regexp_replace(t, ',$', '')), '^[A-Z][A-Za-z0-9_]*$') THEN 'invalid variant name ''' || trim(regexp_replace(t, ',$', '')) || '''' END,
    CASE WHEN t IN ('Unknown', 'Unknown,') THEN '''Unknown'' variant found (empty mnemonic)' END,
    CASE WHEN plain AND NOT regexp_matches(t, '^[A-Z][A-Za-z0-9_]*,$') THEN 'unexpected line outside doc comment: ''' || substr(t, 1, 60) || '''' END], pos FROM p JOIN w ON p.doc_id = w.doc_id AND declared)
SELECT doc_id, CAST(pos AS BIGINT) AS pos, doc_id || coalesce(':' || (pos + 1), '') || ': ' || message AS message FROM (SELECT doc_id, pos, unnest(found) AS message FROM m) WHERE message IS NOT NULL
"""
)
def enum_issues(table):
    """The rules of an enum file over every document's lines; every second document begins like an enum."""
    text = F.concat(F.when(F.col("doc_id") % 2 == 0, "enum X {\n").otherwise(""), F.col("text"))
    lines = table("documents").select(F.col("doc_id").cast("string").alias("file"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    return reports.enum_rules(lines).select(long("file").alias("doc_id"), long("pos").alias("pos"), "message")


@query(
    """
WITH m AS (SELECT CASE WHEN p_partkey % 3 = 0 THEN 'j' WHEN p_partkey % 3 = 1 THEN 'cmov' ELSE 'set' END || CASE p_size % 4 WHEN 0 THEN 'g' WHEN 1 THEN 'z' WHEN 2 THEN 'q' ELSE 'ae' END AS x FROM part)
SELECT x[1] AS first_letter, bool_or(starts_with(x, 'j') AND x[2:] IN ('g', 'z', 'ae')) AS jcc, bool_or(starts_with(x, 'cmov') AND x[5:] IN ('g', 'z', 'ae')) AS cmovcc,
  bool_or(starts_with(x, 'set') AND x[4:] IN ('g', 'z', 'ae')) AS setcc, bool_or(x IN ('jg', 'cmovg', 'setg')) AS signed FROM m GROUP BY ALL
"""
)
def helper_needs(table):
    """Which helpers the generated file of a letter needs."""
    k, code = F.col("p_partkey") % 3, F.col("p_size") % 4
    mnemonic = F.concat(T.first_of((k == 0, "j"), (k == 1, "cmov"), default="set"), T.first_of((code == 0, "g"), (code == 1, "z"), (code == 2, "q"), default="ae"))
    return render.needed_helpers(table("part").select(mnemonic.alias("mnemonic"), F.array(F.lit("x")).alias("body")))


#: A mnemonic for each of the ranked patterns, in their order (some are answered by an earlier one), and four that none fits.
_MNEMONICS = """
vaddpd vsubsd vmulps vdivss minsd vmaxpd paddb paddsw vpaddusb psubd vpsubsw psubusw vpmullq vpmulhuw pmuldq pmuludq pmaddwd vpmaddubsw pand pandn vpor vpxor vandps
vandpd andnps vandnpd vorps orpd vxorps xorpd pslld psrlw vpsraw pslldq psrldq vpsllvw vpsrlvw vpsravq pcmpeqw pcmpgtb vpminsd pminud vpmaxsb vpmaxub vpabsb movaps
movapd movups movupd vmovdqa32 vmovdqu32 vmovss movsd movd movq movlps vmovhps movlpd movhpd vmovlhps vmovhlps movmskps vmovmskpd movntps vmovntpd vmovntdq vmovntdqa
movnti lddqu vcvt pmovzx vpunpcklb unpcklps unpckhps unpcklpd unpckhpd packssdq2ps packusdq2ps vshufps shufpd pshufd vpshufhw pshuflw vpshufb vpalignr vpblendw vpblenddb
blendps vblendpd vblendvps vblendvpd vvpermps permb vvpermi2b vbroadcast132pd pbroadcastps vbroadcast132pd vpbroadcastps gatherx vpgatherps vscatterps vpscatterb fmaddx
fmsub132pd fnmaddb vfnmsub132pd fmaddsubx fmsubaddps vsqrtps sqrtpd vsqrtss vsqrtsd rsqrtps rsqrtss vrcpps rcpss cmpps cmppd vcmpss vcmpsd vucomiss ucomisd vpcmpestri
pcmpestrm vpcmpistri vpcmpistrm aesx pclmulqdq shab crc32 vhaddps haddpd hsubps hsubpd phaddd vphaddsw vphsubw phsubsw vpsadbw mpsadbw dpps vdppd vpinsrb pinsrw pinsrd
vpinsrq insertps pextrb vpextrw pextrd vpextrq extractps vmaskmov132pd pmaskmovx vptest vvtestps vtestpd roundps vroundpd roundss vroundsd vvrndscalex pmovsxb vpmovzxx
vcompressb vexpandb vconflictb vpternlog132pd movbe vpclmulqdq vvpclmulb vgf2p8132pd
""".split() + ["addpx", "vxyz", "pand q", ""]


@query(
    """
WITH ranks(n, rank, expression) AS (VALUES
  (0, 0, 'b::add(o2(), o3())'), (1, 1, 'b::sub(o2(), o3())'), (2, 2, 'b::mul(o2(), o3())'), (3, 3, 'b::unsigned_div(o2(), o3())'), (4, 4, 'b::sub(o2(), o3())'),
  (5, 5, 'b::sub(o3(), o2())'), (6, 6, 'b::add(o2(), o3())'), (7, 7, 'b::add(o2(), o3())'), (8, 8, 'b::add(o2(), o3())'), (9, 9, 'b::sub(o2(), o3())'),
  (10, 10, 'b::sub(o2(), o3())'), (11, 11, 'b::sub(o2(), o3())'), (12, 12, 'b::mul(o2(), o3())'), (13, 13, 'b::mul(o2(), o3())'), (14, 14, 'b::mul(o2(), o3())'),
  (15, 15, 'b::mul(o2(), o3())'), (16, 16, 'b::mul(o2(), o3())'), (17, 17, 'b::mul(o2(), o3())'), (18, 18, 'b::and(o2(), o3())'), (19, 19, 'b::and(u::not(o2()), o3())'),
  (20, 20, 'b::or(o2(), o3())'), (21, 21, 'b::xor(o2(), o3())'), (22, 22, 'b::and(o2(), o3())'), (23, 23, 'b::and(o2(), o3())'), (24, 24, 'b::and(u::not(o2()), o3())'),
  (25, 25, 'b::and(u::not(o2()), o3())'), (26, 26, 'b::or(o2(), o3())'), (27, 27, 'b::or(o2(), o3())'), (28, 28, 'b::xor(o2(), o3())'), (29, 29, 'b::xor(o2(), o3())'),
  (30, 30, 'b::shl(o2(), o3())'), (31, 31, 'b::shr(o2(), o3())'), (32, 32, 'b::sar(o2(), o3())'), (33, 33, 'b::shl(o2(), o3())'), (34, 34, 'b::shr(o2(), o3())'),
  (35, 35, 'b::shl(o2(), o3())'), (36, 36, 'b::shr(o2(), o3())'), (37, 37, 'b::sar(o2(), o3())'), (38, 38, 'b::equal(o2(), o3(), o1_size())'),
  (39, 39, 'b::signed_less(o3(), o2(), o1_size())'), (40, 40, 'b::sub(o2(), o3())'), (41, 41, 'b::sub(o2(), o3())'), (42, 42, 'b::sub(o3(), o2())'),
  (43, 43, 'b::sub(o3(), o2())'), (44, 44, 'o2()'), (45, 45, 'o2()'), (46, 46, 'o2()'), (47, 47, 'o2()'), (48, 48, 'o2()'), (49, 49, 'o2()'), (50, 50, 'o2()'),
  (51, 51, 'o2()'), (52, 52, 'o2()'), (53, 53, 'o2()'), (54, 54, 'o2()'), (55, 55, 'o2()'), (56, 56, 'o2()'), (57, 57, 'o2()'), (58, 58, 'o2()'), (59, 59, 'o2()'),
  (60, 60, 'o2()'), (61, 61, 'o2()'), (62, 62, 'o2()'), (63, 63, 'o2()'), (64, 64, 'o2()'), (65, 65, 'o2()'), (66, 66, 'o2()'), (67, 67, 'o2()'), (68, 68, 'o2()'),
  (69, 69, 'u::zero_extend(o2())'), (70, 70, 'u::sign_extend(o2())'), (71, 71, 'o2()'), (72, 72, 'o2()'), (73, 73, 'o2()'), (74, 74, 'o2()'), (75, 75, 'o2()'),
  (76, 76, 'o2()'), (77, 77, 'o2()'), (78, 78, 'o2()'), (79, 79, 'o2()'), (80, 80, 'o2()'), (81, 81, 'o2()'), (82, 82, 'o2()'), (83, 83, 'o2()'), (84, 84, 'o2()'),
  (85, 85, 'o2()'), (86, 86, 'o2()'), (87, 87, 'o2()'), (88, 88, 'o2()'), (89, 89, 'o2()'), (90, 90, 'o2()'), (91, 91, 'o2()'), (92, 92, 'o2()'), (93, 91, 'o2()'),
  (94, 94, 'o2()'), (95, 95, 'o2()'), (96, 94, 'o2()'), (97, 95, 'o2()'), (98, 98, 'o2()'), (99, 99, 'o2()'), (100, 100, 'o2()'), (101, 101, 'o2()'),
  (102, 102, 'b::add(b::mul(o2(), o3()), o3())'), (103, 103, 'b::sub(b::mul(o2(), o3()), o3())'), (104, 104, 'b::add(u::neg(b::mul(o2(), o3())), o3())'),
  (105, 105, 'b::sub(u::neg(b::mul(o2(), o3())), o3())'), (106, 102, 'b::add(b::mul(o2(), o3()), o3())'), (107, 103, 'b::sub(b::mul(o2(), o3()), o3())'),
  (108, 108, 'o2()'), (109, 109, 'o2()'), (110, 110, 'o2()'), (111, 111, 'o2()'), (112, 112, 'o2()'), (113, 113, 'o2()'), (114, 114, 'o2()'), (115, 115, 'o2()'),
  (116, 116, 'b::equal(o2(), o3(), o1_size())'), (117, 117, 'b::equal(o2(), o3(), o1_size())'), (118, 118, 'b::equal(o2(), o3(), o1_size())'),
  (119, 119, 'b::equal(o2(), o3(), o1_size())'), (120, 120, 'b::sub(o1(), o2())'), (121, 121, 'b::sub(o1(), o2())'), (122, 122, 'o2()'), (123, 123, 'o2()'),
  (124, 124, 'o2()'), (125, 125, 'o2()'), (126, 126, 'exception'), (127, 127, 'exception'), (128, 128, 'exception'), (129, 129, 'exception'),
  (130, 130, 'b::add(o2(), o3())'), (131, 131, 'b::add(o2(), o3())'), (132, 132, 'b::sub(o2(), o3())'), (133, 133, 'b::sub(o2(), o3())'), (134, 134, 'b::add(o2(), o3())'),
  (135, 135, 'b::add(o2(), o3())'), (136, 136, 'b::sub(o2(), o3())'), (137, 137, 'b::sub(o2(), o3())'), (138, 138, 'b::sub(o2(), o3())'), (139, 139, 'b::sub(o2(), o3())'),
  (140, 140, 'b::mul(o2(), o3())'), (141, 141, 'b::mul(o2(), o3())'), (142, 142, 'o2()'), (143, 143, 'o2()'), (144, 144, 'o2()'), (145, 145, 'o2()'), (146, 146, 'o2()'),
  (147, 147, 'o2()'), (148, 148, 'o2()'), (149, 149, 'o2()'), (150, 150, 'o2()'), (151, 151, 'o2()'), (152, 152, 'o2()'), (153, 153, 'o2()'),
  (154, 154, 'b::and(o1(), o2())'), (155, 155, 'b::and(o1(), o2())'), (156, 156, 'b::and(o1(), o2())'), (157, 157, 'o2()'), (158, 158, 'o2()'), (159, 159, 'o2()'),
  (160, 160, 'o2()'), (161, 161, 'o2()'), (162, 70, 'u::sign_extend(o2())'), (163, 70, 'u::sign_extend(o2())'), (164, 164, 'o2()'), (165, 165, 'o2()'), (166, 166, 'o2()'),
  (167, 167, 'b::xor(o2(), o3())'), (168, 168, 'o2()'), (169, 127, 'exception'), (170, 170, 'exception'), (171, 171, 'exception'), (172, NULL, NULL), (173, NULL, NULL),
  (174, NULL, NULL), (175, NULL, NULL)),
m AS (SELECT ps_n.p_partkey, ranks.* FROM part ps_n JOIN ranks ON n = p_partkey % 176)
SELECT p_partkey, CAST(n AS INTEGER) AS n, CAST(rank AS INTEGER) AS rank, expression = 'exception' AS raises,
  CASE WHEN expression <> 'exception' THEN '    let assignment = assign(' || expression || ', o1(), o1_size());' END AS line
FROM m
"""
)
def pattern_ranks(table):
    """The lowest rank that fits each mnemonic, of all ranked patterns, and the line that its body begins with."""
    n = (F.col("p_partkey") % len(_MNEMONICS)).cast("int")
    found = table("part").select("p_partkey", n.alias("n"), dispatch.candidate(F.element_at(F.array(*map(F.lit, _MNEMONICS)), n + 1)).alias("c"))
    first = F.split("c.body", "\n")[0]
    raises = F.contains(first, F.lit("exception("))
    return found.select("p_partkey", "n", "c.rank", raises.alias("raises"), F.when(~raises, first).alias("line"))


@query(
    """
WITH p AS (SELECT p_partkey AS object, p_size AS a, 1000 + p_partkey % 60000 AS c FROM part),
e AS (
  SELECT object, 1 AS place, a AS code, c AS codepoint FROM p UNION ALL SELECT object, 2, 1, 65 FROM p
  UNION ALL SELECT object, 3, 16 + i, c + i FROM p, range(4) t(i)
  UNION ALL SELECT object, 4, 32 + i, [9731, c][i + 1] FROM p, range(2) t(i)
  UNION ALL SELECT object, 5, 48, 9731 FROM p)
SELECT CAST(object AS INTEGER) AS object, CAST(code AS INTEGER) AS code, CAST(arg_max(codepoint, place) AS INTEGER) AS codepoint FROM e GROUP BY object, code
"""
)
def unicode_maps(table):
    """ToUnicode maps of several blocks: single characters, counted and listed ranges; later entries stay, and lists beyond a range are left out."""
    hexed = lambda x: F.lpad(F.hex(x), 4, "0")
    c = 1000 + F.col("p_partkey") % 60000
    text = F.format_string(
        "1 beginbfchar <%s> <%s> endbfchar begincmap 1 beginbfchar <0001><0041D83D> endbfchar 3 beginbfrange <0010> <0013> <%s> <20><21>[<2603> <%s> <0042>] endbfrange beginbfrange <0030><0030><2603> endbfrange",
        hexed(F.col("p_size")), hexed(c), hexed(c), hexed(c),
    )
    return fonts.to_unicode(table("part").select(F.col("p_partkey").cast("int").alias("object"), text.alias("to_unicode")))


@query(
    """
WITH g AS (SELECT p_size AS object, CAST(p_partkey * 37 % 9000 AS INTEGER) AS c, CAST(p_partkey % 23 AS INTEGER) AS glyph FROM part),
r AS (SELECT *, CASE WHEN c BETWEEN 8704 AND 8959 THEN 0 WHEN c BETWEEN 32 AND 126 THEN 1 WHEN c BETWEEN 160 AND 255 THEN 2 WHEN c BETWEEN 880 AND 1023 THEN 3
  WHEN c BETWEEN 8192 AND 8303 THEN 4 WHEN c BETWEEN 8448 AND 8527 THEN 5 WHEN c BETWEEN 8528 AND 8591 THEN 6 WHEN c BETWEEN 256 AND 591 THEN 7 ELSE 8 END AS rank FROM g)
SELECT CAST(object AS INTEGER) AS object, glyph, arg_min(c, rank * 100000 + c) AS codepoint FROM r WHERE rank < 8 OR c >= 592 GROUP BY object, glyph
"""
)
def glyph_priority(table):
    """Glyphs back to code points: the first range of priority, then the smallest."""
    made = table("part").select(F.col("p_size").cast("int").alias("object"), (F.col("p_partkey") * 37 % 9000).cast("int").alias("codepoint"), (F.col("p_partkey") % 23).cast("int").alias("glyph"))
    return fonts.glyph_points(made)
