"""Mixing sources to target weights along a time-varying curriculum, in DataFrame operations only.

Each source has a weight schedule: weights at equally spaced knots of the
training time [0, 1], linear in between. Its integral is the source's weight.
The mix is ``share`` times the words of all documents; each source gets its part
by weight, at most ``max_repeats`` times its own size, and what a source cannot
take is shared again among the others (``targets``).

The documents of a source stand in a fixed order, that of the MD5 of their id.
The mix reads this stream from its start, again from the start where the target
exceeds the source's size, until the target is reached. Word ``p`` of a stream of
``T`` words is needed at the time at which the integral of the schedule reaches
``p / T`` of its total; inverting the integral gives each document its training
position, and documents are range-sorted by position.

How it scales: one scan writes (id, source, words). Streams are cut into ranges
of the MD5, in number twice the shuffle partitions and shared among sources by
rows; their sums and the source table are small and are joined by broadcast
where Spark finds them so. A document's place in the stream is that of its range
plus linear interpolation; only the range in which a source's last pass ends is
ordered document by document. No source is ever gathered in one task.

Rows, one by one: a null or wordless text has size 0 and takes nothing; a null
source is a source of its own, last in order; a null id counts as empty text in
the order. Rows of one source, id and size are ordered as one and share what the
last pass takes of them evenly, rounded down. An empty table gives no rows. Other
columns are not touched by ``assign`` and are kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.common import WORD
from feedlens.session import cut_lineage

SHARE = 1.5
MAX_REPEATS = 2
CYCLE = (3.0, 1.0, 2.0)
FADE, RISE = (1.5, 1.0, 0.5), (0.5, 1.0, 1.5)  # by turns, each with integral 1


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(doc_id: Column) -> Column:
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def cyclic_schedule(sources: DataFrame, cycle: tuple[float, ...] = CYCLE) -> DataFrame:
    """``source, weights``: the weights of ``cycle`` by turns in code point order, null last.

    Sources fade and rise by turns around their weight. One row per source.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, cycle)), (F.pmod("turn", F.lit(len(cycle))) + 1).cast("int"))
    shape = F.when(F.pmod("turn", F.lit(2)) == 0, F.array(*map(F.lit, FADE))).otherwise(F.array(*map(F.lit, RISE)))
    turns = sources.select("source").distinct().withColumn("turn", turn)
    weighted = turns.withColumns({"weight": weight, "shape": shape})
    return weighted.select("source", F.transform("shape", lambda x: x * F.col("weight")).alias("weights"))


def _integrals(weights: Column) -> Column:
    """The schedule's integral from 0 to each knot."""
    steps = F.size(weights) - 1
    parts = F.transform(
        F.slice(weights, F.lit(2), steps), lambda x, i: (F.element_at(weights, i + 1) + x) / 2.0 / steps
    )
    return F.transform(
        weights, lambda _, i: F.aggregate(F.slice(parts, F.lit(1), i), F.lit(0.0), lambda total, x: total + x)
    )


def training_time(fraction: Column, weights: Column, integrals: Column) -> Column:
    """The time at which the integral reaches ``fraction`` (0 to below 1) of its total."""
    wanted = fraction * F.element_at(integrals, -1)
    steps = F.size(weights) - 1
    step = F.greatest(F.lit(1), F.least(F.size(F.filter(integrals, lambda x: x <= wanted)), steps))
    low, high = F.element_at(weights, step), F.element_at(weights, step + 1)
    rest = wanted - F.element_at(integrals, step)
    root = F.sqrt(F.greatest(F.lit(0.0), low * low + 2.0 * (high - low) * steps * rest))
    inside = F.when(rest > 0, 2.0 * rest / (low + root)).otherwise(0.0)
    return (step - 1) / steps.cast("double") + inside


def targets(stats: DataFrame, share: float = SHARE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Adds ``target`` to ``source, source_size, weight``: one row per source.

    Shares by weight with an upper bound of ``max_repeats`` sizes are
    ``least(bound, level * weight)`` for one level. With sources in order of
    bound by weight, the level is the largest, over places in this order, of what
    is left after all bounds before, by the weights that are left.
    """
    bound = F.col("source_size") * max_repeats
    order = Window.orderBy(bound / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) * share - F.coalesce(F.sum(bound).over(before), F.lit(0))) / F.sum(
        "weight"
    ).over(after)
    levelled = stats.withColumn("level", level)
    top = F.max("level").over(everything)
    return levelled.withColumn("target", F.least(bound.cast("double"), top * F.col("weight"))).drop("level")


class Plan:
    """The small tables of a mix: one row per source, and one per range of a source's stream."""

    def __init__(self, sizes: DataFrame, schedule: DataFrame | None, share: float, max_repeats: int):
        spark = sizes.sparkSession
        wanted = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        stats = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
        stats = cut_lineage(stats)
        schedule = cyclic_schedule(stats) if schedule is None else schedule
        same = stats["source"].eqNullSafe(schedule["source"])
        with_weights = stats.join(schedule, same).select(stats["*"], schedule["weights"])
        with_weights = with_weights.withColumn("integrals", _integrals(F.col("weights")))
        with_weights = with_weights.withColumn("weight", F.element_at("integrals", -1))
        everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        ranges = F.ceil(F.col("n_rows") * wanted / F.sum("n_rows").over(everything))
        sources = targets(with_weights.withColumn("n_ranges", ranges), share, max_repeats)
        words = F.floor("target")
        passes = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long")
        self.sources = cut_lineage(
            sources.withColumn("passes", passes).withColumn("rest", words - F.col("passes") * F.col("source_size"))
        )
        self.ranges = self._ranges(sizes)
        self.cuts = self._cuts(sizes)

    def place(self, sizes: DataFrame) -> DataFrame:
        """Joins the source's row; adds the order key, the range and the place inside it."""
        source = self.sources.withColumnRenamed("source", "source_")
        placed = sizes.join(source, sizes["source"].eqNullSafe(F.col("source_"))).drop("source_")
        u = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32)) * F.col("n_ranges")
        placed = placed.withColumn("key", order_key(F.col("doc_id"))).withColumn("u", u)
        return placed.withColumn("range_no", F.floor("u")).withColumn("inside", F.col("u") - F.col("range_no"))

    def _ranges(self, sizes: DataFrame) -> DataFrame:
        """``source, range_no, range_words, range_start``."""
        sums = self.place(sizes).groupBy("source", "range_no").agg(F.sum("size").alias("range_words"))
        before = Window.partitionBy("source").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
        start = F.coalesce(F.sum("range_words").over(before), F.lit(0))
        return cut_lineage(sums.withColumn("range_start", start))

    def _cuts(self, sizes: DataFrame) -> DataFrame:
        """Per source the unit (rows of one key and size) in which its last pass ends, and what it takes of it."""
        source = self.sources.select(F.col("source").alias("source_"), "rest")
        ends = self.ranges.join(source, F.col("source").eqNullSafe(F.col("source_"))).where(
            (F.col("range_start") < F.col("rest")) & (F.col("rest") <= F.col("range_start") + F.col("range_words"))
        ).select("source_", F.col("range_no").alias("range_"), F.col("range_start").alias("start_"))
        placed = self.place(sizes)
        inside = placed.join(
            ends, placed["source"].eqNullSafe(F.col("source_")) & (F.col("range_no") == F.col("range_"))
        )
        units = inside.groupBy("source", "key", "size", "rest", "start_").agg(F.count("*").alias("n_equal"))
        before = Window.partitionBy("source").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
        total = F.col("size") * F.col("n_equal")
        left = F.col("rest") - F.col("start_") - F.coalesce(F.sum(total).over(before), F.lit(0))
        cuts = units.withColumn("left", left).where((F.col("left") > 0) & (F.col("left") <= total))
        return cut_lineage(cuts.select(
            F.col("source").alias("source_"), F.col("key").alias("cut_key"), F.col("size").alias("cut_size"),
            F.floor(F.col("left") / F.col("n_equal")).cast("long").alias("cut_words"),
        ))

    def take(self, sizes: DataFrame) -> DataFrame:
        """Adds ``taken`` and ``stream_start``, the words of the stream before the row."""
        placed = self.place(sizes)
        ranges = self.ranges.select(
            F.col("source").alias("r_source"), F.col("range_no").alias("r_no"), "range_words", "range_start"
        )
        placed = placed.join(
            ranges, placed["source"].eqNullSafe(F.col("r_source")) & (F.col("range_no") == F.col("r_no"))
        ).drop("r_source", "r_no")
        placed = placed.join(self.cuts, placed["source"].eqNullSafe(F.col("source_")), "left").drop("source_")
        unit, cut = F.struct("key", "size"), F.struct(F.col("cut_key").alias("key"), F.col("cut_size").alias("size"))
        last = F.when(F.col("cut_key").isNull(), 0).when(unit < cut, F.col("size"))
        last = last.when(unit == cut, F.col("cut_words")).otherwise(0)
        return placed.withColumn("taken", F.col("passes") * F.col("size") + last).withColumn(
            "stream_start", F.col("range_start") + F.col("inside") * F.col("range_words")
        )


def _position(copy: int | Column) -> Column:
    fraction = (F.col("stream_start") + F.lit(copy) * F.col("source_size")) / F.col("target")
    return F.when((F.col("target") > 0) & (fraction < 1.0),
                  training_time(fraction, F.col("weights"), F.col("integrals")))


def _sizes(docs: DataFrame, text: str, id_column: str, source: str) -> DataFrame:
    return docs.select(
        F.col(id_column).alias("doc_id"), F.col(source).alias("source"), size_of(F.col(text)).alias("size")
    )


def assign(docs: DataFrame, schedule: DataFrame | None = None, text: str = "text", id_column: str = "doc_id",
           source: str = "source", share: float = SHARE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per document, range-sorted by position.

    ``doc_id, source, size, source_size, target, taken`` (words the mix takes,
    repeats counted) and ``position`` (training time of the first copy, null
    where the stream ends before it). ``schedule`` has ``source, weights`` (an
    array of at least two knots, not all zero); without one, ``cyclic_schedule``.
    """
    sizes = cut_lineage(_sizes(docs, text, id_column, source))
    plan = Plan(sizes, schedule, share, max_repeats)
    rows = plan.take(sizes).select(
        "doc_id", "source", "size", "source_size", "target", "taken", _position(0).alias("position")
    )
    rows = cut_lineage(rows)
    order = [F.col("position").asc_nulls_last(), F.col("doc_id")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)


def mix(docs: DataFrame, schedule: DataFrame | None = None, text: str = "text", id_column: str = "doc_id",
        source: str = "source", share: float = SHARE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The mixed documents themselves, whole, range-sorted by training position.

    A document comes once for each pass that takes at least half of it; one
    without words comes as often as passes reach its place.
    """
    sizes = cut_lineage(_sizes(docs, text, id_column, source))
    plan = Plan(sizes, schedule, share, max_repeats)
    held = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("held")
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.col(source).alias("source"), size_of(F.col(text)).alias("size"), held
    )
    last = F.col("taken") - F.col("passes") * F.col("size")
    reached = F.col("stream_start") + F.col("passes") * F.col("source_size") < F.col("target")
    again = F.when(F.col("size") > 0, 2 * last >= F.col("size")).otherwise(reached)
    copies = F.col("passes") + F.when(again, 1).otherwise(0)
    taken = plan.take(rows).withColumn("copies", F.least(copies, F.lit(max_repeats)).cast("int"))
    spread = taken.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    placed = spread.select(F.coalesce(_position(F.col("copy")), F.lit(1.0)).alias("position"), "key", "copy", "held")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["position", "key", "copy"]
    return placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("held.*")


ORACLE_SQL = """
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3.0, 1.0, 2.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)]::DOUBLE AS w
  FROM d GROUP BY source),
l AS (
  SELECT *, (sum(source_size) OVER () * CAST(1.5 AS DOUBLE)
             - coalesce(sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s WINDOW o AS (ORDER BY 2 * source_size / w, source NULLS LAST)),
t AS (
  SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), (SELECT max(level) FROM l) * w) AS target FROM l),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS passes FROM t),
u AS (
  SELECT source, k, size, count(*) AS n_equal,
         sum(size * count(*)) OVER (PARTITION BY source ORDER BY k, size) - size * count(*) AS start
  FROM d GROUP BY source, k, size)
SELECT d.doc_id, d.size, p.source_size, p.target,
       CAST(p.passes * d.size + floor(greatest(0, least(d.size * u.n_equal,
         CAST(floor(p.target) AS BIGINT) - p.passes * p.source_size - u.start)) / u.n_equal) AS BIGINT) AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
JOIN u ON d.source IS NOT DISTINCT FROM u.source AND d.k = u.k AND d.size = u.size
"""
