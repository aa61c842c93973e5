"""Ordered operators that never put a whole group into one task.

A plain ``Window.partitionBy(g).orderBy(o)`` sends every row of a group to one task,
so one hot key (a state, a run, a brand holding a third of the rows) becomes one
straggler.  ``running_scan`` computes the same running values in two levels:

1. the rows are range-partitioned by (group, order columns), as Spark's sort does it, on
   the columns themselves; a hot group, an outlier or a run of nulls spans as many
   partitions as its rows ask for;
2. windows run per (group, partition); a summary (one row per group and partition) gives
   each part the totals of the parts before it.

The partitioned rows are checkpointed once with their partition's number, so both levels,
and any recomputation after a lost executor, see the same cut.  Running values supported:
1-based ordinal, inclusive running sums, the last ordinal (so far) where a condition held,
and the group size.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverlens.session import materialize, work_dir


def micros_ntz(c: Column) -> Column:
    """Microseconds of a TIMESTAMP_NTZ since 1970-01-01, independent of the session time zone.

    Casting to TIMESTAMP would pass through the session zone and is not monotone
    across a daylight-saving gap.
    """
    day = F.unix_date(c.cast("date")).cast("long")
    sec = F.date_part(F.lit("SECOND"), c)  # seconds with the fraction, decimal(8,6)
    return (day * 86_400_000_000 + F.hour(c).cast("long") * 3_600_000_000
            + F.minute(c).cast("long") * 60_000_000 + (sec * 1_000_000).cast("long"))


def _join_back(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null-safe equi-join on ``cols`` that keeps one copy of each key column."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") for c in cols],
                     *[c for c in right.columns if c not in cols])
    cond = reduce(lambda a, b: a & b, [left[c].eqNullSafe(r[f"__r_{c}"]) for c in cols])
    return left.join(r, cond, "inner").drop(*[f"__r_{c}" for c in cols])


def running_scan(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    *,
    descending: bool = False,
    ordinal: str = "ordinal",
    sums: Mapping[str, Column] | None = None,
    last_pos_where: Mapping[str, Column] | None = None,
    group_size: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add running values over ``order`` within each ``by`` group (empty ``by`` = whole table).

    ``order`` must be a total order inside a group (add a tie-breaker column), as the
    reference's row order is; nulls come first ascending, last descending.  ``sums`` maps
    output name -> numeric expression (running inclusive sum).  ``last_pos_where`` maps output
    name -> boolean expression; the output is the ordinal of the last row up to and including
    this one where it held (null when none).  ``group_size`` names an optional column with the
    group's row count.

    The rows are cut into ``partitions`` ranges (default: the session's shuffle partitions, the
    setting that follows the data's size).  The input is computed once.
    """
    if not order:
        raise ValueError("running_scan needs an explicit order")
    sums = dict(sums or {})
    last_pos_where = dict(last_pos_where or {})
    spark = df.sparkSession
    n = int(partitions or spark.conf.get("coverlens.scan.partitions", None) or spark.conf.get("spark.sql.shuffle.partitions"))
    base_cols = df.columns
    keys = list(by)

    # Measures become plain columns first: an output name may equal a column another measure reads.
    staged = df.withColumns({
        **{f"__s{i}": expr for i, expr in enumerate(sums.values())},
        **{f"__c{i}": F.coalesce(cond, F.lit(False)) for i, cond in enumerate(last_pos_where.values())},
    }) if (sums or last_pos_where) else df
    sort = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    cut = staged.repartitionByRange(n, *[F.col(k).asc() for k in keys], *sort)
    cut = materialize(cut.withColumn("__b", F.spark_partition_id()))

    w_rank = Window.partitionBy(*keys, "__b").orderBy(*sort)
    w_run = w_rank.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cut.withColumn("__lord", F.row_number().over(w_rank).cast("long"))
    if sums or last_pos_where:
        local = local.withColumns({
            **{f"__ls{i}": F.sum(f"__s{i}").over(w_run) for i in range(len(sums))},
            **{f"__lp{i}": F.max(F.when(F.col(f"__c{i}"), F.col("__lord"))).over(w_run)
               for i in range(len(last_pos_where))},
        })

    # One row per (group, part): its size, sums, and last local position per condition.
    summary = local.groupBy(*keys, "__b").agg(
        F.count(F.lit(1)).alias("__bn"),
        *[F.sum(f"__s{i}").alias(f"__bs{i}") for i in range(len(sums))],
        *[F.max(F.when(F.col(f"__c{i}"), F.col("__lord"))).alias(f"__bp{i}") for i in range(len(last_pos_where))],
    )
    w_prev = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offs = summary.withColumns({
        "__off": F.coalesce(F.sum("__bn").over(w_prev), F.lit(0)).cast("long"),
        **{f"__os{i}": F.sum(f"__bs{i}").over(w_prev) for i in range(len(sums))},
        **({"__gn": F.sum("__bn").over(Window.partitionBy(*keys)).cast("long")} if group_size else {}),
    })
    if last_pos_where:
        offs = offs.withColumns({f"__op{i}": F.max(F.col("__off") + F.col(f"__bp{i}")).over(w_prev)
                                 for i in range(len(last_pos_where))})
    offs = offs.drop("__bn", *[f"__bs{i}" for i in range(len(sums))],
                     *[f"__bp{i}" for i in range(len(last_pos_where))])

    out = _join_back(local, offs, [*keys, "__b"])
    extra = [(F.col("__off") + F.col("__lord")).alias(ordinal)]
    extra += [(F.col(f"__ls{i}") + F.coalesce(F.col(f"__os{i}"), F.lit(0))).alias(name) for i, name in enumerate(sums)]
    extra += [F.coalesce(F.col("__off") + F.col(f"__lp{i}"), F.col(f"__op{i}")).alias(name)
              for i, name in enumerate(last_pos_where)]
    names = [ordinal, *sums, *last_pos_where]
    if group_size:
        extra.append(F.col("__gn").alias(group_size))
        names.append(group_size)
    return out.select(*[c for c in base_cols if c not in names], *extra)


def ntile_of(ordinal: Column, size: Column, k: int | Column) -> Column:
    """1-based batch of a 1-based ``ordinal`` among ``size`` rows cut into ``k`` contiguous batches.

    Batch sizes are size div k, with the first (size mod k) batches one larger —
    the same bounds as SQL ``ntile(k)``.
    """
    k = k if isinstance(k, Column) else F.lit(k)
    q = F.floor(size / k)
    r = size - q * k
    i0 = ordinal - 1
    big = r * (q + 1)
    return (F.when(i0 < big, F.floor(i0 / (q + 1)))
            .otherwise(r + F.floor((i0 - big) / F.nullif(q, F.lit(0))))
            + 1).cast("long")


def ntile_start(batch: int, size: Column, k: int) -> Column:
    """0-based index of the first row of 1-based ``batch`` (of ``k``) in a list of ``size`` rows."""
    q = F.floor(size / F.lit(k))
    r = size - q * k
    b0 = F.lit(batch - 1)
    return F.when(b0 < r, b0 * (q + 1)).otherwise(r * (q + 1) + (b0 - r) * q).cast("long")


def _same(left: DataFrame, right: DataFrame, cols: Sequence[str], names: Sequence[str]) -> Column:
    """Null-safe equality of ``left``'s columns ``cols`` with ``right``'s columns ``names``."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[n]) for c, n in zip(cols, names, strict=True)], F.lit(True))


def top_k_per_group(df: DataFrame, by: Sequence[str], order: Sequence[str], k: int, *,
                    descending: bool = False, rank_col: str | None = None,
                    partitions: int | None = None) -> DataFrame:
    """First ``k`` rows of each group in ``order`` (a limit that is the feature: previews, recent items).

    A task passes on at most ``k`` rows of a group, the tasks of one of about sqrt(tasks) salts at
    most ``k`` together, and the last step picks among the salts: two small shuffles, whatever
    the size of the table or of a group, and no sort or checkpoint of the whole.  The salt is the task's number, on which
    the result does not depend.  ``order`` must be total inside a group.
    """
    spark = df.sparkSession
    n = int(partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    rank, salt = rank_col or "__rank", "__salt"
    sort = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    salted = df.withColumn(salt, F.pmod(F.spark_partition_id(), F.lit(max(2, math.isqrt(n)))))
    some = salted.withColumn(rank, F.row_number().over(Window.partitionBy(*by, salt).orderBy(*sort))).filter(F.col(rank) <= k).drop(rank, salt)
    out = some.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*sort)).cast("long")).filter(F.col(rank) <= k)
    return out if rank_col else out.drop(rank)


#: Sampled keys by which the first round of ``rank_cuts`` cuts an interval.  A round leaves about
#: a 16th of the rows, so the next may take 16 times as many at the same cost, up to ``MOST_PIVOTS``
#: (the largest limit that Spark applies before a shuffle by default).
PIVOTS = 32
MOST_PIVOTS = 1000


def rank_cuts(df: DataFrame, by: Sequence[str], order: Sequence[str], ranks: Mapping[str, Column], pivots: int = PIVOTS) -> DataFrame:
    """Order keys at given places of each group, without sorting the table: rows (by, cut, n, key).

    ``ranks`` maps a name to a 0-based place, an expression over the group's size ``n``; ``key`` is
    the struct of the ``order`` columns of the row there, null for a place outside the group.  ``order`` must be total
    inside a group; nulls come first.

    Distributed selection: each round samples a few keys of the interval that a cut is known to
    lie in, counts the rows between them exactly, and keeps the one interval that holds the
    place.  ``pivots`` keys are sampled first, more as the intervals shrink.  A round reads the ``by`` and ``order``
    columns only, shuffles counts and samples, and collects nothing but whether all is found.
    """
    by = list(by)
    rows = df.select(*by, F.struct(*order).alias("__k"))
    kind = rows.schema["__k"].dataType.simpleString()
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).cast("long").alias("n"))
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("cut"), at.cast("long").alias("left")) for name, at in ranks.items()]))
    # left: place inside the interval [lo, hi) that holds the key; a missing bound is open.
    # The state of a round is a small written table: its size is known anew, not guessed from the joins behind it.
    root, spark = work_dir(df.sparkSession, "rank-cuts"), df.sparkSession

    def written(state: DataFrame, name: object) -> DataFrame:
        state.write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    cuts = written(sizes.select(*by, "n", wanted.alias("c")).select(
        *by, "n", "c.*", F.lit(None).cast(kind).alias("lo"), F.lit(None).cast(kind).alias("hi"),
        ((F.col("c.left") < 0) | (F.col("c.left") >= F.col("n"))).alias("done")).withColumns({"key": F.col("lo"), "stuck": F.lit(False)}), "start")
    names = [f"__b{i}" for i in range(len(by))]
    for seed in range(64):
        drawn_keys = min(pivots * 16**min(seed, 4), max(pivots, MOST_PIVOTS))
        todo = cuts.filter(~F.col("done")).select(*[F.col(c).alias(x) for c, x in zip(by, names, strict=True)], "cut", "lo", "hi")
        state = cuts.agg(F.count_if(~F.col("done")).alias("open"), F.count_if("stuck").alias("stuck")).first()
        if state.stuck:
            raise ValueError("order columns do not tell the rows of a group apart")
        if not state.open:
            return cuts.select(*by, "cut", "n", "key")
        inside = rows.join(todo, _same(rows, todo, by, names)).filter(
            (F.col("lo").isNull() | (F.col("__k") >= F.col("lo"))) & (F.col("hi").isNull() | (F.col("__k") < F.col("hi"))))
        drawn = top_k_per_group(inside.select(*by, "cut", "__k", F.xxhash64(F.lit(seed), "__k").alias("__h")), [*by, "cut"], ["__h", "__k"], drawn_keys)
        marks = written(drawn.groupBy(*by, "cut").agg(F.sort_array(F.collect_list("__k")).alias("__p")), f"marks{seed}")
        held = marks.select(*[F.col(c).alias(x) for c, x in zip(by, names, strict=True)], F.col("cut").alias("__c"), "__p")
        counted = (inside.select(*by, "cut", "__k").alias("i").join(held, _same(inside, held, by, names) & (F.col("i.cut") == F.col("__c")))
                   .select(*by, "cut", F.size(F.filter("__p", lambda x: x <= F.col("__k"))).alias("slot"))
                   .groupBy(*by, "cut", "slot").agg(F.count(F.lit(1)).alias("m")))
        slots = counted.groupBy(*by, "cut").agg(F.sort_array(F.collect_list(F.struct("slot", "m"))).alias("s"))
        # The first slot that reaches the place, and the rows before it.
        walked = F.expr("aggregate(s, named_struct('before', 0L, 'slot', -1), (a, x) -> if(a.slot >= 0 OR a.before + x.m <= left, "
                        "named_struct('before', a.before + if(a.slot >= 0, 0L, x.m), 'slot', a.slot), named_struct('before', a.before, 'slot', x.slot)))")
        found = marks.join(slots, _same(marks, slots, [*by, "cut"], [*by, "cut"])).select(
            *[marks[c].alias(x) for c, x in zip(by, names, strict=True)], marks["cut"].alias("__c"), "__p", "s")
        new = cuts.join(found, _same(cuts, found, [*by, "cut"], [*names, "__c"]), "left").withColumn("w", walked)
        lo = F.coalesce(F.get("__p", F.col("w.slot") - 1), F.col("lo"))
        hi = F.coalesce(F.get("__p", F.col("w.slot")), F.col("hi"))
        left = F.col("left") - F.col("w.before")
        hit = (left == 0) & lo.isNotNull()
        # All rows of the interval were sampled, or nothing was gained: equal keys.
        stuck = ~hit & ((F.size("__p") < drawn_keys) | (lo.eqNullSafe(F.col("lo")) & hi.eqNullSafe(F.col("hi"))))
        step = new.select(*by, "n", "cut", "done", *[F.when(F.col("done"), F.col(c)).otherwise(x).alias(c) for c, x in (
            ("left", left), ("lo", lo), ("hi", hi), ("key", F.when(hit, lo)))], (~F.col("done") & stuck).alias("stuck"), (F.col("done") | hit).alias("now"))
        cuts = written(step.drop("done").withColumnRenamed("now", "done"), seed)
    raise ValueError("order columns do not tell the rows of a group apart")


#: Groups up to which ``slice_by_rank`` also filters by literal bounds, which reach the scan.
LITERAL_GROUPS = 64


def slice_by_rank(df: DataFrame, by: Sequence[str], order: Sequence[str], start: Column, stop: Column) -> DataFrame:
    """Rows whose 0-based place in their group is from ``start`` up to, not including, ``stop`` (expressions over the size ``n``).

    The two keys that bound a slice are selected (``rank_cuts``), then the table is filtered by
    them: nothing is sorted or numbered.  For up to ``LITERAL_GROUPS`` groups the bounds of the
    first order column are also literals of the filter, so a scan can skip row groups.
    """
    by, spark = list(by), df.sparkSession
    last = F.least(stop, F.col("n")) - 1
    cuts = rank_cuts(df, by, order, {"a": F.greatest(start, F.lit(0)), "z": F.when(last >= F.greatest(start, F.lit(0)), last).otherwise(-1)})
    bounds = cuts.groupBy(*by).agg(F.max(F.when(F.col("cut") == "a", F.col("key"))).alias("__a"), F.max(F.when(F.col("cut") == "z", F.col("key"))).alias("__z"))
    bounds = bounds.filter("__a IS NOT NULL AND __z IS NOT NULL")
    few = bounds.select(*by, F.col(f"__a.{order[0]}").alias("__lo"), F.col(f"__z.{order[0]}").alias("__hi")).limit(LITERAL_GROUPS + 1).collect()
    if not few:
        return df.limit(0)
    if len(few) <= LITERAL_GROUPS and all(r["__lo"] is not None for r in few):
        first = F.col(order[0])
        df = df.filter(reduce(lambda x, y: x | y, [
            reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.lit(r[c])) for c in by], (first >= F.lit(r["__lo"])) & (first <= F.lit(r["__hi"])))
            for r in few]))
    names = [f"__b{i}" for i in range(len(by))]
    right = bounds.select(*[F.col(c).alias(x) for c, x in zip(by, names, strict=True)], "__a", "__z")
    key = F.struct(*order)
    return df.join(right, _same(df, right, by, names)).filter((key >= F.col("__a")) & (key <= F.col("__z"))).drop(*names, "__a", "__z")
