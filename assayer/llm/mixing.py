"""Mixing sources to target weights along a curriculum, in DataFrame operations only.

Each source has a share of all words by its weight, but at most ``CAP`` times
its own words; what it can't give is shared anew by weight.  Its documents,
in an order as if at random, are taken whole ``floor(target / size)`` times,
and those at the front once more, until the target is met to the word (the
last of them in part).  Each source's weight changes over training, from
``start`` to ``end`` along a line.  The integral of that schedule is its
cumulative demand of words; a document's place in the source's stream, put
into the inverse of the demand, is its training position between 0 and 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, order_key, running_before

CAP = 3
CYCLE = 3
WORD = r"[^\\x20\\x09-\\x0D]+"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.expr(f"regexp_count({text}, '{WORD}')"), F.lit(0)).cast("bigint")


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """Weights 1, 2, 3, repeating, by the sources' code points, null last; with start and end of each schedule.

    Sources of weight 1 fade in, those of weight 3 fade out, those of weight 2
    stay; the mean over training is the weight.  Source names are ranked in
    two steps, by their first character and within it, so that no task ranks
    them all.
    """
    first = sizes.withColumn("_first", F.substring("source", 1, 1))
    inside = first.withColumn("_inside", F.row_number().over(Window.partitionBy("_first").orderBy("source")))
    letters = inside.groupBy("_first").agg(F.max("_inside").alias("_n"))
    before = Window.orderBy(F.col("_first").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    starts = letters.select(F.col("_first").alias("_f"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    rank = F.col("_start") + F.col("_inside") - 1
    weight = (F.pmod(rank, F.lit(CYCLE)) + 1).cast("double")
    tilt = (weight - 2) / 2
    return inside.join(starts, F.col("_first").eqNullSafe(F.col("_f"))).select(
        "source",
        "source_size",
        weight.alias("weight"),
        (weight * (1 - tilt)).alias("start"),
        (weight * (1 + tilt)).alias("end"),
    )


def targets(sources: DataFrame, cap: int = CAP) -> DataFrame:
    """Add ``target``: the share of all words by weight, at most ``cap`` times the source's own.

    A few sums at a time come to the driver, never the sources.  A source
    whose share exceeds its cap is fixed there; the rest is shared among the
    others, until no share exceeds its cap.
    """
    sources = cut(sources)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    limit = F.col("source_size") * cap / F.col("weight")
    while True:
        # A source is full once the level, the words for each unit of weight, reaches its limit.
        full = limit <= level
        row = sources.agg(
            F.sum(F.when(full, F.col("source_size") * cap).otherwise(0)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if not row[1]:
            break
        risen = (total - row[0]) / row[1]
        if risen <= level:
            break
        level = risen
    return sources.withColumn("target", F.least(F.col("source_size") * cap, F.col("weight") * level).cast("double"))


def position(share: Column, start: Column, end: Column) -> Column:
    """The time at which ``share`` of a source's words are asked for, under a weight going from start to end.

    The demand up to time t is start t + (end - start) t^2 / 2, out of
    (start + end) / 2 in all; solved for t in the form that also holds for an
    even schedule.
    """
    asked = share * (start + end) / 2
    return 2 * asked / (start + F.sqrt(start * start + 2 * (end - start) * asked))


def mix(docs: DataFrame, cap: int = CAP) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, position) of every document, sorted by position.

    ``docs`` has doc_id, source and text.  A null text has no words; a null
    source is a source.  ``taken`` counts words, with repeats; a document of
    which nothing is taken has no position and comes last.  Repeated rows
    share the words that fall to them.  An empty table gives an empty result.
    """
    sized = docs.select("doc_id", "source", word_count().alias("size"), order_key("doc_id").alias("key"))
    sized = cut(sized)
    sources = targets(ranked_sources(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), cap)
    placed = running_before(sized, ["source"], "key", ["doc_id", "size"], F.col("size"), "before")
    known = sources.select(F.col("source").alias("_s"), "source_size", "target", "start", "end")
    joined = placed.join(known, F.col("source").eqNullSafe(F.col("_s")))
    # Whole rounds through the source, and the words of one more round.
    words = F.round("target").cast("bigint")
    rounds = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("bigint")
    rest = words - rounds * F.col("source_size")
    more = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    taken = rounds * F.col("size") + more
    middle = rounds * F.col("before") + F.least(F.col("before"), rest) + taken / 2
    at = F.when(taken > 0, position(middle / words, F.col("start"), F.col("end")))
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken"), at.alias("position")
    ).orderBy(F.col("position").asc_nulls_last(), "doc_id")


def mixed(docs: DataFrame, cap: int = CAP) -> DataFrame:
    """The documents of the mix in training order, each as often as it is taken, with all their columns.

    A document is never cut: what is taken in part is taken whole.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    found = mix(docs.select("doc_id", "source", "text"), cap).filter("taken > 0")
    copies = found.groupBy("doc_id", "source", "size").agg(
        F.ceil(F.sum("taken") / (F.count(F.lit(1)) * F.col("size"))).cast("int").alias("_copies"),
        F.min("position").alias("_position"),
    )
    # Repeated rows with one id, source and size share one place in the stream.
    left = docs.select(row, F.col("doc_id").alias("_d"), F.col("source").alias("_s"), word_count().alias("_n"))
    same = F.col("_d").eqNullSafe(F.col("doc_id")) & F.col("_s").eqNullSafe(F.col("source"))
    joined = left.join(copies, same & (F.col("_n") == F.col("size")))
    times = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return times.orderBy("_position", "doc_id", "_copy").select("_row.*")


# The same by DuckDB.  The level of the shares is found in closed form: sources in the order of their limits,
# the first prefix of full ones that leaves a level below the next limit.
SQL = r"""
with d as (select doc_id, source, md5(coalesce(cast(doc_id as varchar), 'null')) as k,
                  cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
           from documents),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
w as (select *, cast(1 + (row_number() over (order by source nulls last) - 1) % 3 as double) as weight from s),
o as (select *, 3 * source_size / weight as bound,
             coalesce(sum(3 * source_size) over p, 0) as full_size, sum(weight) over q as open_weight,
             (select sum(size) from d) as total
      from w
      window p as (order by 3 * source_size / weight, source nulls last
                   rows between unbounded preceding and 1 preceding),
             q as (order by 3 * source_size / weight, source nulls last rows between current row and unbounded following)),
level as (select (total - full_size) / open_weight as level from o
          where (total - full_size) / open_weight <= bound order by bound, source nulls last limit 1),
t as (select source, source_size, weight, cast(least(3 * source_size, weight * level) as double) as target,
             weight * (1 - (weight - 2) / 2) as a, weight * (1 + (weight - 2) / 2) as b
      from w, level),
r as (select d.doc_id, d.size, t.source_size, t.target, a, b,
             cast(coalesce(sum(d.size) over (partition by d.source order by d.k, d.doc_id, d.size
                      rows between unbounded preceding and 1 preceding), 0) as bigint) as before,
             cast(round(t.target) as bigint) as words,
             case when t.source_size > 0 then cast(round(t.target) as bigint) // t.source_size else 0 end as rounds
      from d join t on d.source is not distinct from t.source),
n as (select *, words - rounds * source_size as rest,
             rounds * size + greatest(0, least(size, words - rounds * source_size - before)) as taken from r),
m as (select *, (rounds * before + least(before, rest) + taken / 2) / words * (a + b) / 2 as asked from n)
select doc_id, size, source_size, target, cast(taken as bigint) as taken,
       round(case when taken > 0 then 2 * asked / (a + sqrt(a * a + 2 * (b - a) * asked)) end, 9) as position
from m
"""
