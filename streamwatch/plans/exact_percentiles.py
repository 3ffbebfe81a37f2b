"""Exact percentiles per group, of any number of columns, in two reads and without ordering a group.

1. The first read sketches every column of each group (KLL: a few thousand values, mergeable). Sketches of one group are merged by slots of scan
   tasks first, then the slots. A sketch gives each percentile a bracket, two values that very likely enclose it.
2. The second read computes the plain aggregates, counts the values below each bracket, and counts the values inside, value by value: one
   aggregation, in which a row stands once for its group and once for each bracket that it falls into. A bracket holds about ``2 * MARGIN`` of its
   group.

A bracket that proves to miss its percentile is opened on that side, and the groups concerned are read again. What a bracket holds is
ordered by one task up to ``ORDERED`` distinct values; beyond that it is cut at its own percentiles, level by level, and only the part that holds
the percentile goes on.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamwatch.functions.sketches import quantiles, sketched
from streamwatch.operators.window_stats import WINDOW, Measures, flatten_window
from streamwatch.plans.group_join import GROUP_ROWS, join_group_statistics
from streamwatch.session import checkpoint_root

#: Size of the sketches. Their rank error is below 0.1 % of the group in 99 of 100 cases.
SKETCH = 4096
#: How far a bracket reaches to both sides, as a share of the group.
MARGIN = 0.0025
#: Distinct values that one task orders, and parts that a larger bracket is cut into.
ORDERED = 1 << 20
PARTS = 256

GROUP, CUT, VALUE, COUNT, WANTED = "__group", "__cut", "__value", "__count", "__wanted"
WHOLE = -1  # the cut of a row that stands for its group


def aggregate_with_percentiles(rows: DataFrame, measures: Measures, keys: Sequence[str]) -> DataFrame:
    """The window, ``keys``, and the columns of ``measures``: aggregates, and exact percentiles, each the least value that at least
    this share of the group's values do not exceed. ``rows`` are those of ``open_windows``; they are read twice."""
    checkpoint_root(rows.sparkSession)
    cuts = [(column, name, q) for column, own in measures.exact.items() for name, q in own.items()]
    group = ["window_start", "window_end", *keys]
    flat = flatten_window(rows)
    stats = sketched(flat, group, list(measures.exact), SKETCH)
    brackets = []
    for column, own in measures.exact.items():
        reach = MARGIN
        sides = [side for q in own.values() for side in (max(0.0, q - reach), min(1.0, q + reach))]
        brackets.append(quantiles(f"{column}_sketch", f"{column}_n", sides).alias(f"{column}_sides"))
    stats = stats.select(*group, GROUP_ROWS, *(f"{column}_n" for column in measures.exact), *brackets)
    # for each cut: the bracket, open where a side is null, and whether it is wanted
    places = {column: 0 for column in measures.exact}
    found = []
    for column, _, q in cuts:
        k, places[column] = places[column], places[column] + 2
        side = lambda at, column=column: F.get(f"{column}_sides", F.lit(at))
        rank = F.greatest(F.lit(1), F.ceil(F.lit(Decimal(str(q))) * F.col(f"{column}_n"))).cast("long")
        found.append(F.struct(side(k).alias("low"), side(k + 1).alias("high"), (F.col(f"{column}_n") > 0).alias("wanted"), rank.alias("rank")))
    stats = stats.select(*group, GROUP_ROWS, F.array(*found).alias("__brackets")).checkpoint()

    counted = _counted(flat, stats, group, keys, cuts, measures.aggregates).checkpoint()
    plain, values = counted.filter(F.col(CUT) == WHOLE), None
    while True:
        wanted, inside = _placed(counted, stats, group, len(cuts))
        found, any_missed = _ordered(wanted, inside)
        values = found if values is None else values.unionByName(found)
        if not any_missed:
            break
        stats = _opened(wanted, len(cuts)).checkpoint()
        counted = _counted(flat, stats, group, keys, cuts, (), within=True).checkpoint()

    names = [*_output_names(measures), *(name for _, name, _ in cuts)]
    plain = plain.select(*group, *_output_names(measures), *(F.lit(None).cast("double").alias(name) for _, name, _ in cuts))
    values = values.select(
        *group,
        *(F.lit(None).cast(plain.schema[name].dataType).alias(name) for name in _output_names(measures)),
        *(F.when(F.col(CUT) == i, F.col(VALUE)).alias(name) for i, (_, name, _) in enumerate(cuts)),
    )
    # a null key is a key like any other here, which a join would not see
    both = plain.unionByName(values).groupBy(*group).agg(*(F.first(name, ignorenulls=True).alias(name) for name in names))
    window = F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end")).alias(WINDOW)
    return both.select(window, *keys, *names)


def _output_names(measures: Measures) -> list[str]:
    from streamwatch.operators.window_stats import _name_of

    return list(dict.fromkeys(map(_name_of, measures.aggregates)))


def _counted(flat: DataFrame, stats: DataFrame, group: Sequence[str], keys: Sequence[str], cuts: list, aggregates: Sequence[Column], *, within: bool = False) -> DataFrame:
    """Per group, cut and value inside the cut's bracket the count; and per group, as cut ``WHOLE``, the aggregates and what lies below each bracket.
    ``within``: only rows of the groups in ``stats``."""
    joined = join_group_statistics(flat, stats.drop("window_end"), keys)
    if within:
        joined = joined.filter(F.col("__brackets").isNotNull())
    standing, below = [F.struct(F.lit(WHOLE).alias(CUT), F.lit(None).cast("double").alias(VALUE))], []
    for i, (column, _, _) in enumerate(cuts):
        bracket, value = F.get("__brackets", F.lit(i)), F.col(column)
        inside = bracket["wanted"] & (bracket["low"].isNull() | (value >= bracket["low"])) & (bracket["high"].isNull() | (value <= bracket["high"]))
        standing.append(F.when(inside & value.isNotNull(), F.struct(F.lit(i).alias(CUT), value.alias(VALUE))))
        below.append(F.count_if(F.coalesce(value < bracket["low"], F.lit(False))).alias(f"__below_{i}"))
    # a filter on what explode() gives is cheaper than one on the array
    rows = joined.withColumn("__stand", F.explode(F.array(*standing))).filter("__stand is not null")
    rows = rows.select("*", f"__stand.{CUT}", f"__stand.{VALUE}")
    return rows.groupBy(*group, CUT, VALUE).agg(*aggregates, *below, F.count("*").alias(COUNT))


def _placed(counted: DataFrame, stats: DataFrame, group: Sequence[str], cuts: int) -> tuple[DataFrame, DataFrame]:
    """From the counts: per group and cut the wanted place among the values inside the bracket, and the values. Groups are structs, in which
    nulls equal each other."""
    key = F.struct(*group).alias(GROUP)
    inside = counted.filter(F.col(CUT) >= 0).select(key, CUT, VALUE, COUNT)
    whole = counted.filter(F.col(CUT) == WHOLE).select(key, *(f"__below_{i}" for i in range(cuts))).join(stats.select(key, "__brackets"), GROUP)
    each = [F.struct(F.lit(i).alias(CUT), F.get("__brackets", F.lit(i)).alias("bracket"), F.col(f"__below_{i}").alias("below")) for i in range(cuts)]
    wanted = whole.select(GROUP, F.explode(F.array(*each)).alias("c")).select(GROUP, f"c.{CUT}", "c.bracket", "c.below").filter("bracket.wanted")
    sizes = inside.groupBy(GROUP, CUT).agg(F.sum(COUNT).alias("size"), F.count("*").alias("distinct"))
    wanted = wanted.join(sizes, [GROUP, CUT], "left")
    place = F.col("bracket.rank") - F.col("below")
    return wanted.withColumn(WANTED, place).withColumn("hit", (place >= 1) & (place <= F.coalesce("size", F.lit(0)))), inside


def _opened(wanted: DataFrame, cuts: int) -> DataFrame:
    """New brackets of the groups that were missed, open on the side where their percentile must be."""
    low = F.when(F.col(WANTED) >= 1, F.col("bracket.high"))
    high = F.when(F.col(WANTED) < 1, F.col("bracket.low"))
    opened = F.struct(low.alias("low"), high.alias("high"), F.lit(True).alias("wanted"), F.col("bracket.rank").alias("rank"))
    nothing = F.struct(F.lit(0.0).alias("low"), F.lit(0.0).alias("high"), F.lit(False).alias("wanted"), F.lit(0).cast("long").alias("rank"))
    again = [F.coalesce(F.max(F.when(F.col(CUT) == i, opened)), nothing) for i in range(cuts)]
    missed = wanted.filter(~F.col("hit")).groupBy(GROUP).agg(F.array(*again).alias("__brackets"))
    return missed.select(f"{GROUP}.*", F.lit(1).cast("long").alias(GROUP_ROWS), "__brackets")


def _ordered(wanted: DataFrame, inside: DataFrame) -> tuple[DataFrame, bool]:
    """The columns of the group, the cut and its value, that at the wanted place among the values inside; and whether brackets were missed."""
    state = wanted.agg(F.coalesce(F.max("distinct"), F.lit(0)), F.coalesce(F.bool_or(~F.col("hit")), F.lit(False))).first()
    wanted, most = wanted.filter("hit").select(GROUP, CUT, WANTED, "distinct"), state[0]
    while most > ORDERED:
        wanted, inside = _narrowed(wanted, inside)
        most = wanted.agg(F.max("distinct")).first()[0]
    order = Window.partitionBy(GROUP, CUT).orderBy(VALUE).rowsBetween(Window.unboundedPreceding, 0)
    ranked = inside.withColumn("__up_to", F.sum(COUNT).over(order))
    found = ranked.join(wanted, [GROUP, CUT]).filter((F.col("__up_to") >= F.col(WANTED)) & (F.col("__up_to") - F.col(COUNT) < F.col(WANTED)))
    return found.select(f"{GROUP}.*", CUT, VALUE), state[1]


def _narrowed(wanted: DataFrame, inside: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Brackets with more than ``ORDERED`` distinct values, of which there are few against the rows, are cut at their own percentiles; the part with the
    wanted place stays."""
    large = wanted.filter(F.col("distinct") > ORDERED)
    known = F.broadcast(large.select(GROUP, CUT))
    ranks = [k / PARTS for k in range(1, PARTS)]
    cut = inside.join(known, [GROUP, CUT]).groupBy(GROUP, CUT).agg(F.kll_sketch_agg_double(VALUE, F.lit(SKETCH)).alias("sketch"))
    cut = cut.select(GROUP, CUT, F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, ranks))).alias("borders")).checkpoint()
    part = F.size(F.filter("borders", lambda border: border < F.col(VALUE)))
    parted = inside.join(F.broadcast(cut), [GROUP, CUT]).withColumn("part", part)
    sums = parted.groupBy(GROUP, CUT, "part").agg(F.sum(COUNT).alias("sum"), F.count("*").alias("values"))
    before = Window.partitionBy(GROUP, CUT).orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    chosen = sums.withColumn("up_to", F.sum("sum").over(before)).join(large.drop("distinct"), [GROUP, CUT])
    chosen = chosen.filter((F.col("up_to") >= F.col(WANTED)) & (F.col("up_to") - F.col("sum") < F.col(WANTED)))
    chosen = chosen.select(GROUP, CUT, "part", (F.col(WANTED) - F.col("up_to") + F.col("sum")).alias(WANTED), F.col("values").alias("distinct")).checkpoint()
    kept = parted.join(F.broadcast(chosen.select(GROUP, CUT, "part")), [GROUP, CUT, "part"]).select(GROUP, CUT, VALUE, COUNT)
    others = inside.join(known, [GROUP, CUT], "left_anti")
    rest = wanted.filter(F.col("distinct") <= ORDERED)
    return rest.unionByName(chosen.drop("part")).checkpoint(), others.unionByName(kept).checkpoint()
