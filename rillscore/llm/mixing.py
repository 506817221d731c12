"""Mixing sources to target weights by weighted fair queueing, with DataFrame operations only.

Every document of a source gets a place in a shuffled order (md5 of its id). A pass over the source may be repeated up to
`passes` times; the virtual finish time of a repeat is the source's words up to and including it, divided by the source's
target. All repeats of all sources are taken in the order of finish times until the budget (all words) is spent, so each
source stops within one document of its target.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillscore.llm.common import table

WORDS = "[^\\x20\\x09-\\x0D]+"


def source_targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), passes: int = 3) -> DataFrame:
    """sources(source, source_size) -> with w (weights in code point order of source, null last, repeating) and target.

    The shares are by weight; a target stops at passes * source_size and the excess is shared by weight again until no
    target is above: the level at which that ends is found from the sources in the order of limit / weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    out = sources.withColumn("i", F.row_number().over(by_name) - 1)
    out = out.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("i") % len(weights) + 1).cast("int")).cast("long"))
    out = out.withColumn("cap", F.col("source_size") * passes).withColumn("total", F.sum("source_size").over(Window.partitionBy()))
    out = out.withColumn("full", F.sum("cap").over(by_ratio) - F.col("cap")).withColumn("left", F.sum("w").over(Window.partitionBy()) - F.sum("w").over(by_ratio) + F.col("w"))
    fits = (F.col("total") - F.col("full")) * F.col("w") <= F.col("cap") * F.col("left")
    level = F.min(F.when(fits, F.struct("full", ((F.col("total") - F.col("full")).cast("double") / F.col("left").cast("double")).alias("level")))).over(Window.partitionBy())
    out = out.withColumn("level", level["level"])
    return out.select("source", "source_size", "w", F.least(F.col("cap").cast("double"), F.col("w") * F.col("level")).alias("target"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), passes: int = 3, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row: id, size (words), source_size, target (its source's), taken (words the mix takes, repeats counted).

    Null and empty texts have size 0 and take 0. A null source is a source, the last one. Repeated rows are documents of
    their own; ties of the shuffled order go by id and size, so reruns agree. Repeats that finish at the same time are
    taken together or not at all. An empty table gives an empty table; sizes that are all 0 give targets of 0.

    Running sums need no task that holds a source: rows are dealt to (source, range of the shuffled order) cells, cells
    are summed first, and each cell adds the sum of the cells before it. The budget's cut is found by summing ranges of
    finish times, 1,024 at a time.
    """
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    sized = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
        F.conv(F.substring(F.md5(ident.cast("binary")), 1, 15), 16, 10).cast("long").alias("h"),
    )
    sized = table(sized, "sized")
    n = sized.count()
    bits = min(16, max(8, math.ceil(math.log2(max(1, n) / 2000 + 1))))
    # A null source compares as a source in joins and groups.
    sized = sized.withColumn("s", F.coalesce(F.concat(F.lit("v"), "source"), F.lit("n"))).withColumn("cell", F.shiftright("h", 60 - bits))
    cells = sized.groupBy("s", "cell").agg(F.sum("size").alias("in_cell"), F.first("source").alias("source"))
    before = cells.withColumn("before", F.sum("in_cell").over(Window.partitionBy("s").orderBy("cell")) - F.col("in_cell")).select("s", "cell", "before")
    sources = cells.groupBy("s").agg(F.sum("in_cell").alias("source_size"), F.first("source").alias("source"))
    targets = table(source_targets(sources.select("source", "source_size"), weights, passes), "targets")
    known = targets.select(F.coalesce(F.concat(F.lit("v"), "source"), F.lit("n")).alias("s"), "source_size", "target")
    cell_info = before.join(known, "s")
    run = F.sum("size").over(Window.partitionBy("s", "cell").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, 0))
    # The cells are few next to the rows, but grow with the sources: Spark's own size check decides how they are joined.
    queue = sized.withColumn("run", run).join(cell_info, ["s", "cell"]).select("id", "size", "source_size", "target", (F.col("before") + F.col("run")).alias("cum"))
    queue = table(queue, "queue")

    finish = F.transform(F.sequence(F.lit(0), F.lit(passes - 1)), lambda e: (e * F.col("source_size") + F.col("cum")).cast("double") / F.when(F.col("target") > 0, F.col("target")))
    cut = _cut(passes, queue.where("size > 0 AND target > 0").select(F.explode(finish).alias("v"), "size"), targets)
    repeats = F.size(F.filter(finish, lambda v: v <= F.lit(cut)))
    taken = F.when((F.col("size") > 0) & (F.col("target") > 0), F.col("size") * repeats).otherwise(F.lit(0)).cast("long")
    return queue.select(F.col("id").alias(id_col), "size", "source_size", "target", taken.alias("taken"))


def _cut(passes: int, repeats: DataFrame, targets: DataFrame, ranges: int = 1024, few: int = 5000) -> float:
    """The latest finish time v such that all repeats up to v fit the budget; at most a few thousand sums come back."""
    top = targets.agg(F.sum("source_size").alias("budget"), F.max(passes * F.col("source_size") / F.when(F.col("target") > 0, F.col("target"))).alias("v")).first()
    if not top.budget:
        return 0.0
    low, high, spent = 0.0, top.v * 1.000001, 0
    while True:
        at = F.floor((F.col("v") - F.lit(low)) / F.lit((high - low) / ranges))
        sums = repeats.where((F.col("v") >= F.lit(low)) & (F.col("v") < F.lit(high))).groupBy(at.alias("at")).agg(F.sum("size").alias("size"), F.count("*").alias("n"), F.min("v").alias("first"), F.max("v").alias("last"))
        latest = low
        for r in sorted(sums.collect(), key=lambda r: r["at"]):
            if spent + r["size"] > top.budget:
                break
            spent, latest = spent + r["size"], r["last"]
        else:
            return latest
        if r["n"] <= few or r["first"] == r["last"]:
            for x in repeats.where(F.col("v").between(r["first"], r["last"])).groupBy("v").agg(F.sum("size").alias("size")).orderBy("v").collect():
                if spent + x["size"] > top.budget:
                    break
                spent, latest = spent + x["size"], x["v"]
            return latest
        low, high = r["first"], math.nextafter(r["last"], math.inf)


ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
named AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS i
  FROM sized GROUP BY source),
caps AS (SELECT *, i % 3 + 1 AS w, 3 * source_size AS cap, (sum(source_size) OVER ())::BIGINT AS total FROM named),
ranked AS (
  SELECT *, (sum(cap) OVER r - cap)::BIGINT AS before, ((sum(w) OVER ()) - (sum(w) OVER r) + w)::BIGINT AS remaining
  FROM caps WINDOW r AS (ORDER BY cap / w, encode(source) NULLS LAST ROWS UNBOUNDED PRECEDING)),
level AS (
  SELECT arg_min((total - before)::DOUBLE / remaining::DOUBLE, before) AS level FROM ranked
  WHERE (total - before) * w <= cap * remaining),
targets AS (SELECT source, source_size, total, least(cap::DOUBLE, w * level) AS target FROM ranked, level),
queue AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.total,
         (sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h, s.doc_id, s.size ROWS UNBOUNDED PRECEDING))::BIGINT AS cum
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
repeats AS (SELECT (e * source_size + cum)::DOUBLE / target AS v, size, total FROM queue, range(3) r(e) WHERE size > 0 AND target > 0),
running AS (SELECT v, sum(sum(size)) OVER (ORDER BY v) AS spent, any_value(total) AS total FROM repeats GROUP BY v),
cut AS (SELECT max(v) AS v FROM running WHERE spent <= total)
SELECT doc_id, size, source_size, target,
       CASE WHEN size > 0 AND target > 0 THEN size * (
         (cum::DOUBLE / target <= cut.v)::INT + ((source_size + cum)::DOUBLE / target <= cut.v)::INT
         + ((2 * source_size + cum)::DOUBLE / target <= cut.v)::INT) ELSE 0 END::BIGINT AS taken
FROM queue, cut
"""
