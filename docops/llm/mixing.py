"""Mixing sources to target weights by Pareto order sampling of whole documents.

Each source gets a share of the mix by its weight, at most ``most_copies`` times its
size; what a capped source cannot take is shared out again by weight. Inside a source
the expected copies of a document follow its size class: short fragments are taken
less often. The whole part of the expectation is certain. The fractional part is a
chance of inclusion: documents are ranked by the odds of a random number divided by the
odds of inclusion, and taken in that order up to the words the source still needs.

* Size is the number of words; null text counts 0. Empty documents take part with 0 words.
* A null source is a source of its own, last in the order of code points.
* Random numbers are hashes of the id, so reruns agree; rows without id use their text.
* Rows of one source with the same id and size stand or fall together.
* An empty table gives an empty result. Other columns are kept; one that has the name of a
  result column gives way to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docops.llm.common import set_aside, stored, table, word_count
from docops.plans.skew import OrderedRanges, checked_broadcast

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MOST_COPIES = 2
SEED = 20
#: Blocks of the rank order for each source; only the block at the border is sorted.
BLOCKS = 4096
#: Size at which a document has half of the full chance, as an exponent of two.
HALF_CHANCE = 6

#: Expected copies are proportional to 2**class / (2**class + 2**HALF_CHANCE), in 1,024ths.
_CLASS = "length(bin(size)) - CAST(size = 0 AS INT)"
_MEASURE = "CAST(floor(1024 * pow(2, _class) / (pow(2, _class) + {half}) + 0.5) AS BIGINT)"


def source_targets(
    totals: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = SHARE_PERCENT, most: int = MOST_COPIES
) -> DataFrame:
    """Adds ``target`` to rows of (source, source_size), one for each source.

    Sources are numbered in ordered ranges and the level is found by aggregates, so
    there may be any number of them.
    """
    named = totals.withColumn("_null", F.col("source").isNull())
    numbered = OrderedRanges(named, ["_null", "source"]).numbered("_n").drop("_null")
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), ((F.col("_n") - 1) % len(weights) + 1).cast("int"))
    weighed = stored(numbered.select("source", "source_size", weight.alias("weight")), "mixing-sources")
    level = None
    while True:
        full = F.lit(False) if level is None else most * F.col("source_size") <= F.lit(level) * F.col("weight")
        row = weighed.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, F.col("source_size"))).alias("capped"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
        ).first()
        if not row["open"]:
            break  # every source is taken as often as it may be
        new = (percent * row["all"] - 100 * most * (row["capped"] or 0)) / (100.0 * row["open"])
        if new == level:
            break
        level = new
    full_size = (most * F.col("source_size")).cast("double")
    share = full_size if level is None else F.least(full_size, F.lit(level) * F.col("weight"))
    return weighed.select("source", "source_size", share.alias("target"))


def _by_source(rows: DataFrame, side: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined with one row of ``side`` for each source, null included."""
    values = [F.col(f"s.{c}") for c in side.columns if c != "source"]
    on = F.col("r.source").eqNullSafe(F.col("s.source"))
    return rows.alias("r").join(side.alias("s"), on, how).select("r.*", *values)


def expected_copies(classes: DataFrame, targets: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """Adds ``expected`` to rows of (source, class, words): copies whose words add up to the target."""
    above = Window.partitionBy("source").orderBy(F.col("_class").desc())
    before = above.rowsBetween(Window.unboundedPreceding, -1)
    rows = _by_source(classes, checked_broadcast(targets))
    rows = rows.withColumn("measure", F.expr(_MEASURE.format(half=2**HALF_CHANCE)))
    rows = rows.withColumn("_top", F.coalesce(F.sum("words").over(before), F.lit(0)))
    rows = rows.withColumn(
        "_rest", F.sum(F.col("words") * F.col("measure")).over(above.rowsBetween(0, Window.unboundedFollowing))
    )
    factor = F.when(F.col("_rest") > 0, (F.col("target") - most * F.col("_top")) / F.col("_rest"))
    # The factor is right where the largest class that is not capped stays below the cap.
    fits = F.when(factor * F.col("measure") <= most, factor)
    rows = rows.withColumn("_factor", F.max(F.struct(fits.isNotNull().alias("ok"), F.col("_class"), fits.alias("f"))).over(Window.partitionBy("source")))
    capped = ~F.col("_factor.ok") | (F.col("_class") > F.col("_factor._class"))
    expected = F.when(capped, F.lit(float(most))).otherwise(F.least(F.lit(float(most)), F.col("_factor.f") * F.col("measure")))
    return rows.select("source", "_class", "words", "source_size", "target", expected.alias("expected"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    percent: int = SHARE_PERCENT,
    most: int = MOST_COPIES,
    seed: int = SEED,
    size: Column | None = None,
) -> DataFrame:
    """Every row of ``docs`` with size, source_size, target, copies (0 to ``most``) and taken words."""
    size = word_count("text") if size is None else size
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.col("text").cast("binary")), F.lit(""))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary")), 1, 13)
    unit = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**52)
    given = docs.drop("size", "source_size", "target", "copies", "taken").select("*", size)
    docs, back = set_aside(given, ("doc_id", "source", "text"))
    docs = docs.withColumnRenamed(docs.columns[-1], "size")
    narrow = stored(
        docs.select("doc_id", "source", "size", unit.alias("_u")).withColumn("_class", F.expr(_CLASS)),
        "mixing-sizes",
    )
    classes = narrow.groupBy("source", "_class").agg(F.sum("size").alias("words"))
    classes = stored(classes, "mixing-classes")
    targets = source_targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")), weights, percent, most)
    plan = stored(expected_copies(classes, targets, most), "mixing-plan")

    # One row for each source: the words still needed, and the mean chance that spreads the blocks.
    chance = F.col("expected") - F.floor("expected")
    needs = plan.groupBy("source").agg(
        F.first("target").alias("target"),
        F.sum(F.col("words") * F.floor("expected")).alias("_sure"),
        F.sum(F.when(chance > 0, F.col("words"))).alias("_open"),
    )
    need = F.col("target") - F.col("_sure")
    mean = F.least(F.greatest(F.try_divide(need, F.col("_open")), F.lit(1e-6)), F.lit(1 - 1e-6))
    needs = needs.select("source", need.alias("_need"), F.coalesce(mean, F.lit(0.5)).alias("_mean"))
    needs = needs.withColumnRenamed("target", "_target")
    by_class = checked_broadcast(_by_source(plan, needs)).alias("p")

    def ranked(rows: DataFrame) -> DataFrame:
        joined = rows.alias("r").join(
            by_class, F.col("r.source").eqNullSafe(F.col("p.source")) & (F.col("r._class") == F.col("p._class"))
        )
        odds = (F.col("_u") / (1 - F.col("_u"))) * ((1 - chance) / chance)
        spread = odds * (F.col("_mean") / (1 - F.col("_mean")))
        block = F.least(F.floor(F.lit(BLOCKS) * (spread / (1 + spread))), F.lit(BLOCKS - 1))
        return joined.select(
            "r.*",
            "source_size",
            "target",
            "_need",
            F.floor("expected").cast("long").alias("_whole"),
            F.when(chance > 0, odds).alias("_odds"),
            F.when(chance > 0, block).cast("long").alias("_block"),
        )

    lottery = ranked(narrow).where("_odds IS NOT NULL")
    blocks = lottery.groupBy("source", "_block").agg(F.sum("size").alias("_words"), F.first("_need").alias("_need"))
    before = Window.partitionBy("source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0)))
    # The block in which the words run out; later blocks are left, earlier ones taken.
    border = blocks.where("_before < _need").groupBy("source").agg(
        F.max(F.struct("_block", "_before")).alias("_border")
    )
    border = checked_broadcast(border.select("source", "_border._block", "_border._before"))
    at = lottery.alias("l").join(
        border.alias("b"),
        F.col("l.source").eqNullSafe(F.col("b.source")) & (F.col("l._block") == F.col("b._block")),
    ).select("l.*", "b._before")
    order = Window.partitionBy("source").orderBy("_odds", "doc_id")
    run = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    at = at.withColumn("_run", F.col("_before") + F.coalesce(run, F.lit(0)))
    last = (
        at.where("_run + size / 2.0D <= _need")
        .groupBy("source")
        .agg(F.max(F.struct("_odds", "doc_id")).alias("_last"))
    )
    cuts = _by_source(border, last, "left").select("source", F.col("_block").alias("_cut"), "_last")
    cuts = checked_broadcast(stored(cuts, "mixing-cuts"))
    rows = ranked(docs.withColumn("_u", unit).withColumn("_class", F.expr(_CLASS)))
    rows = _by_source(rows, cuts, "left")
    first = F.struct(F.col("_odds"), F.col("doc_id")) <= F.col("_last")
    drawn = (F.col("_block") < F.col("_cut")) | ((F.col("_block") == F.col("_cut")) & F.coalesce(first, F.lit(False)))
    copies = F.col("_whole") + F.when(F.coalesce(drawn, F.lit(False)), 1).otherwise(0)
    return rows.select(
        *back[:-1],
        "size",
        "source_size",
        "target",
        copies.cast("long").alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
    )


def op4_mixing(spark, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "copies", "taken")


def mixing_sql(source: str = "documents") -> str:
    """DuckDB SQL for ``mix`` with the default parameters."""
    half = 2**HALF_CHANCE
    weight = f"[{', '.join(map(str, WEIGHTS))}][CAST((n - 1) % {len(WEIGHTS)} + 1 AS BIGINT)]"
    return f"""
WITH sized AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS
    BIGINT) AS size, coalesce(CAST(doc_id AS VARCHAR), md5(text), '') AS id FROM {source}),
docs AS (SELECT doc_id, source, size, length(bin(size)) - CAST(size = 0 AS INTEGER) AS class,
    (CAST(CAST('0x' || substr(md5('{SEED}:' || id), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / {float(2**52)!r} AS u FROM sized),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
named AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS n FROM totals),
weighed AS (SELECT source, source_size, CAST({weight} AS BIGINT) AS w FROM named),
capping AS (SELECT *, row_number() OVER o AS m, coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING
    AND 1 PRECEDING), 0) AS capped, sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
    sum(source_size) OVER () AS total FROM weighed WINDOW o AS (ORDER BY source_size / w, source NULLS LAST)),
level AS (SELECT min_by(CAST({SHARE_PERCENT} * total - {100 * MOST_COPIES} * capped AS DOUBLE) / (100.0::DOUBLE * open), m)
    AS level FROM capping WHERE {MOST_COPIES} * source_size > CAST({SHARE_PERCENT} * total - {100 * MOST_COPIES} * capped AS DOUBLE)
    / (100.0::DOUBLE * open) * w),
targets AS (SELECT source, source_size, least(CAST({MOST_COPIES} * source_size AS DOUBLE), coalesce(level * w, 1e300)) AS target
    FROM weighed, level),
classes AS (SELECT source, class, CAST(sum(size) AS BIGINT) AS words, CAST(floor(1024 * pow(2, class) /
    (pow(2, class) + {half}) + 0.5) AS BIGINT) AS measure FROM docs GROUP BY source, class),
factors AS (SELECT c.*, t.source_size, t.target, CASE WHEN rest > 0 THEN (t.target - {MOST_COPIES} * top) / CAST(rest AS DOUBLE) END
    AS factor FROM (SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY class DESC ROWS BETWEEN UNBOUNDED
    PRECEDING AND 1 PRECEDING), 0) AS top, sum(words * measure) OVER (PARTITION BY source ORDER BY class DESC ROWS
    BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM classes) c JOIN targets t
    ON c.source IS NOT DISTINCT FROM t.source),
fitting AS (SELECT source, max(class) AS top_class, max_by(factor, class) AS f FROM factors
    WHERE factor * measure <= {MOST_COPIES} GROUP BY source),
plan AS (SELECT f.source, f.class, f.words, f.source_size, f.target, CASE WHEN g.f IS NULL OR f.class > g.top_class
    THEN {float(MOST_COPIES)} ELSE least({float(MOST_COPIES)}, g.f * f.measure) END AS expected FROM factors f LEFT JOIN fitting g
    ON f.source IS NOT DISTINCT FROM g.source),
needs AS (SELECT source, any_value(target) - sum(words * floor(expected)) AS need FROM plan GROUP BY source),
ranked AS (SELECT d.doc_id, d.source, d.size, p.source_size, p.target, CAST(floor(p.expected) AS BIGINT) AS whole, n.need,
    CASE WHEN p.expected > floor(p.expected) THEN (u / (1 - u)) * ((1 - (p.expected - floor(p.expected))) /
    (p.expected - floor(p.expected))) END AS odds FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
    AND d.class = p.class JOIN needs n ON d.source IS NOT DISTINCT FROM n.source),
drawn AS (SELECT *, odds IS NOT NULL AND coalesce(sum(size) OVER (PARTITION BY source, odds IS NULL ORDER BY odds, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2.0::DOUBLE <= need AS draw FROM ranked)
SELECT doc_id, size, source_size, target, whole + CAST(draw AS BIGINT) AS copies,
    (whole + CAST(draw AS BIGINT)) * size AS taken FROM drawn"""


QUERIES = {"op4_mixing": op4_mixing}
SQL = {"op4_mixing": mixing_sql()}
