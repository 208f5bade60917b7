"""Augmented analytics: change points, trend, seasonality, drivers, causal effect, correlation."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tracewell.functions.columns import day_index, explode_once, ratio, total, two_sided_probability
from tracewell.operators.relational import join_null_safe
from tracewell.operators.timeseries import with_fit
from tracewell.session import cut_lineage

# Phase of a date for each seasonal component: (phase expression, smoothing rows).
SEASONS = {
    "daily": (lambda d: F.hour(d), 25),
    "weekly": (lambda d: F.dayofweek(d), 7),
    "monthly": (lambda d: F.dayofmonth(d), 31),
    "quarterly": (lambda d: F.pmod(F.month(d) - 1, F.lit(3)), 91),
    "yearly": (lambda d: F.month(d), 365),
}


def segment_series(df: DataFrame, data_col: str, timestamp_col: str, series_cols: Sequence[str] = (),
                   penalty: float = 3.0, min_length: int = 7) -> DataFrame:
    """Add ``segment``, the regime of constant level each row belongs to.

    Binary segmentation, all segments of all series in step: prefix sums give
    the gain of every split, the best one per segment is taken when it beats
    ``penalty * noise * ln(n)``; noise is half the mean squared difference of
    neighbours. Rounds go on until no segment splits; each is written, so the
    plan does not grow. A segment is named by the number of rows before it.
    """
    whole = Window.partitionBy(*series_cols)
    in_order = whole.orderBy(timestamp_col)
    y = F.col(data_col).cast("double")
    out = (
        df.withColumn("_y", y)
        .withColumn("_diff", F.col("_y") - F.lag("_y").over(in_order))
        .withColumn("_n_all", F.count("_y").over(whole))
        .withColumn("_limit", F.lit(penalty) * F.sum(F.col("_diff") * F.col("_diff")).over(whole)
                    / F.nullif(2.0 * (F.col("_n_all") - 1), F.lit(0.0)) * F.log("_n_all"))
        .withColumn("segment", F.lit(0).cast("bigint"))
        .drop("_diff", "_n_all")
    )
    while True:
        part = Window.partitionBy(*series_cols, "segment")
        left = part.orderBy(timestamp_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = cut_lineage(
            out.withColumn("_n", F.count("_y").over(part)).withColumn("_s", F.sum("_y").over(part))
            .withColumn("_c", F.count("_y").over(left)).withColumn("_p", F.sum("_y").over(left))
            .withColumn("_gain", F.when(
                (F.col("_c") >= min_length) & (F.col("_n") - F.col("_c") >= min_length),
                F.col("_c") * (F.col("_n") - F.col("_c")) / F.col("_n")
                * F.pow(F.col("_p") / F.col("_c") - (F.col("_s") - F.col("_p")) / (F.col("_n") - F.col("_c")), 2)))
            .withColumn("_best", F.max("_gain").over(part))
            .withColumn("_cut", F.min(F.when(F.col("_gain") == F.col("_best"), F.col("_c"))).over(part))
            .withColumn("_split", F.coalesce(F.col("_best") > F.col("_limit"), F.lit(False)))
            .withColumn("segment", F.col("segment") + F.when(
                F.col("_split") & (F.col("_c") > F.col("_cut")), F.col("_cut")).otherwise(0))
            .drop("_n", "_s", "_c", "_p", "_gain", "_best", "_cut"))
        if out.filter("_split").isEmpty():
            return out.drop("_y", "_limit", "_split")
        out = out.drop("_split")


def detect_change_points(df: DataFrame, data_col: str, timestamp_col: str,
                         series_cols: Sequence[str] = (), **options) -> DataFrame:
    """One row per regime: begin_timestamp, end_timestamp, metrics(count, avg, min, max)."""
    y = F.col(data_col).cast("double")
    return (
        segment_series(df, data_col, timestamp_col, series_cols, **options)
        .groupBy(*series_cols, "segment")
        .agg(F.min(timestamp_col).alias("begin_timestamp"), F.max(timestamp_col).alias("end_timestamp"),
             F.struct(F.count(y).alias("count"), F.avg(y).alias("avg"), F.min(y).alias("min"),
                      F.max(y).alias("max")).alias("metrics"))
        .drop("segment")
    )


def seasonality(df: DataFrame, data_col: str, timestamp_col: str, series_cols: Sequence[str] = (),
                components: Sequence[str] = ("weekly",)) -> DataFrame:
    """Add one column per seasonal component.

    The series minus its centred moving average (full windows only) is averaged
    per phase and centred so that the phases sum to zero.
    """
    w = Window.partitionBy(*series_cols)
    y = F.col(data_col).cast("double")
    for name in components:
        phase, rows = SEASONS[name]
        around = w.orderBy(timestamp_col).rowsBetween(-(rows // 2), rows // 2)
        same = Window.partitionBy(*series_cols, "_phase")
        df = (
            df.withColumn("_phase", phase(F.col(timestamp_col)))
            .withColumn("_off", F.when(F.count(F.lit(1)).over(around) == rows, y - F.avg(y).over(around)))
            .withColumn("_mean", F.avg("_off").over(same))
            .withColumn("_rows", F.count("_off").over(same))
            .withColumn("_weight", F.when(F.col("_off").isNotNull(), F.lit(1.0) / F.col("_rows")))
            .withColumn(name, F.col("_mean") - F.sum(F.col("_mean") * F.col("_weight")).over(w)
                        / F.sum("_weight").over(w))
            .drop("_phase", "_off", "_mean", "_rows", "_weight")
        )
    return df


def joint_seasonality(df: DataFrame, data_col: str, timestamp_col: str, series_cols: Sequence[str] = (),
                      components: Sequence[str] = ("weekly", "yearly"), rounds: int = 5) -> DataFrame:
    """Add one column per seasonal component and ``remainder``, the components estimated jointly.

    The series minus its centred mean over the longest component's window (full
    windows only) is what the components explain. Each is fitted, as centred
    means per phase, to what the others leave, in ``rounds`` rounds, so that
    what weekdays and months share does not count twice. Sums per phase come
    from one table of (series, phases of all components), which is no longer
    than the calendar; a phase without a full window gets NULL. ``remainder`` is
    the series without its centred mean and its components.
    """
    y, longest = F.col(data_col).cast("double"), max(components, key=lambda name: SEASONS[name][1])
    rows = SEASONS[longest][1]
    around = Window.partitionBy(*series_cols).orderBy(timestamp_col).rowsBetween(-(rows // 2), rows // 2)
    phases = {name: f"_{name}_phase" for name in components}
    out = (df.withColumn("_off", F.when(F.count(F.lit(1)).over(around) == rows, y - F.avg(y).over(around)))
           .withColumns({phase: SEASONS[name][0](F.col(timestamp_col)) for name, phase in phases.items()}))
    out = cut_lineage(out)
    cells = out.filter("_off IS NOT NULL").groupBy(*series_cols, *phases.values()).agg(
        F.sum("_off").alias("_sum"), F.count("_off").alias("_rows"))
    cells = cut_lineage(cells.withColumns({name: F.lit(0.0) for name in components}))
    whole = Window.partitionBy(*series_cols)
    for turn in range(rounds):
        for name, phase in phases.items():
            same = Window.partitionBy(*series_cols, phase)
            others = [F.col(c) for c in components if c != name]
            left = F.col("_sum") - F.col("_rows") * total(others) if others else F.col("_sum")
            mean = F.sum(left).over(same) / F.sum("_rows").over(same)
            weight = F.lit(1.0) / F.count(F.lit(1)).over(same)
            cells = (cells.withColumn("_mean", mean).withColumn("_weight", weight)
                     .withColumn(name, F.col("_mean") - F.sum(F.col("_mean") * F.col("_weight")).over(whole)
                                 / F.sum("_weight").over(whole)).drop("_mean", "_weight"))
        cells = cut_lineage(cells)
    for name, phase in phases.items():
        effect = cells.groupBy(*series_cols, phase).agg(F.first(name).alias(name))
        out = join_null_safe(out, effect, [*series_cols, phase], "left")
    remainder = F.col("_off") - total([F.col(name) for name in components])
    return out.withColumn("remainder", remainder).drop("_off", *phases.values())


def trend(df: DataFrame, data_col: str, timestamp_col: str, horizon: int,
          smoothing_window_size: int = 7, adjust_step_changes: bool = False,
          series_cols: Sequence[str] = (), step_days: int = 1, *, fit_rows: int) -> DataFrame:
    """History and ``horizon`` forecast rows: timestamp, time_series_type, data, trend.

    The trend is the centred mean of the series without its weekly component;
    with ``adjust_step_changes`` the regime levels are taken out before
    smoothing and put back. A line through the last ``fit_rows`` trend values
    extends it: the window of the model, which the caller states. A weekday that
    never has a full window around it has no weekly component.
    """
    w = Window.partitionBy(*series_cols)
    half = smoothing_window_size // 2
    around = w.orderBy(timestamp_col).rowsBetween(-half, half)
    y = F.col(data_col).cast("double")

    out = seasonality(df, data_col, timestamp_col, series_cols).withColumn(
        "weekly", F.coalesce("weekly", F.lit(0.0)))
    if adjust_step_changes:
        out = segment_series(out, data_col, timestamp_col, series_cols)
        level = F.avg(y).over(Window.partitionBy(*series_cols, "segment"))
    else:
        level = F.lit(0.0)
    weekday = F.dayofweek(timestamp_col)
    out = (
        out.withColumn("_level", level)
        .withColumn("trend", F.avg(y - F.col("weekly") - F.col("_level")).over(around) + F.col("_level"))
        .withColumn("_x", day_index(F.col(timestamp_col), step_days))
        .withColumn("_recent", F.row_number().over(w.orderBy(F.desc(timestamp_col))) <= fit_rows)
        .withColumn("_rx", F.when(F.col("_recent"), F.col("_x")))
        .withColumn("_rt", F.when(F.col("_recent"), F.col("trend")))
        .withColumn("_slope", F.coalesce(F.regr_slope("_rt", "_rx").over(w), F.lit(0.0)))
        .withColumn("_base", F.avg("_rt").over(w) - F.col("_slope") * F.avg("_rx").over(w))
        .withColumn("_weekly", F.map_from_entries(F.collect_set(F.struct(weekday, F.col("weekly"))).over(w)))
        .withColumn("_last", F.max(timestamp_col).over(w) == F.col(timestamp_col))
        .withColumn("_h", F.explode(F.when(F.col("_last"), F.sequence(F.lit(0), F.lit(horizon)))
                                    .otherwise(F.array(F.lit(0)))))
    )
    is_future = F.col("_h") > 0
    future_day = F.date_add(timestamp_col, F.col("_h") * step_days)
    line = F.col("_base") + F.col("_slope") * (F.col("_x") + F.col("_h"))
    future_weekly = F.coalesce(F.try_element_at(F.col("_weekly"), F.dayofweek(future_day)), F.lit(0.0))
    return out.select(
        *series_cols, future_day.alias(timestamp_col),
        F.when(is_future, "forecast").otherwise("history").alias("time_series_type"),
        F.when(is_future, line + future_weekly).otherwise(y).alias(data_col),
        F.when(is_future, line).otherwise(F.col("trend")).alias("trend"))


def segment_report(segments: DataFrame, totals: Column, top_k: int, min_support: float) -> DataFrame:
    """Key figures of segments (drivers, metric_interest, metric_reference), the ``top_k`` that moved most."""
    mi, mr = F.col("metric_interest"), F.col("metric_reference")
    i, r = mi.cast("double"), mr.cast("double")
    ti, tr = F.col("_total")["i"].cast("double"), F.col("_total")["r"].cast("double")
    expected = r * F.try_divide(ti - i, tr - r)
    scored = segments.select("drivers", mi, mr, totals.alias("_total")).select(
        "drivers", mi, mr, ratio(i - r, r).alias("relative_difference"),
        (i - F.coalesce(expected, r)).alias("unexpected_difference"),
        F.greatest(ratio(i, ti), ratio(r, tr)).alias("apriori_support"))
    return (
        scored.filter(F.col("apriori_support") >= min_support)
        .orderBy(F.desc(F.abs("unexpected_difference")), "drivers").limit(top_k)
        .orderBy(F.desc("relative_difference"), "drivers")
    )


def _metric(df: DataFrame, column: str) -> Column:
    """The metric as it is if it is a decimal, whose sums do not depend on their order, else as double."""
    return F.col(column) if isinstance(df.schema[column].dataType, DecimalType) else F.col(column).cast("double")


def _named(dimension: str) -> Column:
    return F.concat(F.lit(f"{dimension}="), F.coalesce(F.col(dimension).cast("string"), F.lit("NULL")))


def key_drivers(df: DataFrame, metric_col: str, dimension_cols: Sequence[str], interest_label_col: str,
                top_k: int = 10, min_support: float = 0.1) -> DataFrame:
    """Segments of one or more dimensions, in all combinations, whose metric moved most.

    Facts are reduced to one row per combination of all dimensions before they
    are expanded into grouping sets, so the expansion never touches raw rows.
    There are 2^d grouping sets; for many dimensions see :func:`supported_drivers`.
    """
    metric, label = _metric(df, metric_col), F.col(interest_label_col)
    cells = df.groupBy(*dimension_cols).agg(
        F.sum(F.when(label, metric).otherwise(0)).alias("i"), F.sum(F.when(label, 0).otherwise(metric)).alias("r"))
    sets = [[F.col(c) for c in combo] for k in range(1, len(dimension_cols) + 1)
            for combo in itertools.combinations(dimension_cols, k)]
    named = [F.when(F.grouping(d) == 0, _named(d)) for d in dimension_cols]
    grouped = cells.groupingSets(sets, *[F.col(d) for d in dimension_cols]).agg(
        F.array_sort(F.array_compact(F.array(*named))).alias("drivers"),
        F.sum("i").alias("metric_interest"), F.sum("r").alias("metric_reference"))
    totals = cells.agg(F.struct(F.sum("i").alias("i"), F.sum("r").alias("r"))).scalar()
    return segment_report(grouped, totals, top_k, min_support)


def supported_drivers(df: DataFrame, metric_col: str, dimension_cols: Sequence[str], interest_label_col: str,
                      top_k: int = 10, min_support: float = 0.1) -> DataFrame:
    """As :func:`key_drivers`, for many dimensions.

    Segments grow by one dimension a level, and only from segments with enough
    support: what a segment lacks, none inside it has. Support is bounded by the
    absolute values of the metric, so that negative ones hide nothing. Supported
    values and segments have numbers; a combination of all dimensions is the
    numbers of its values and of the segments it is in. After each level, values
    and segments that no longer grow are left out, and combinations that agree in
    the rest become one. Of one choice of dimensions, at most 2 / ``min_support``
    segments of a metric without negative values are supported; those of a level
    are read to the driver.
    """
    spark = df.sparkSession
    metric, label = _metric(df, metric_col), F.col(interest_label_col)
    i, r = F.when(label, metric).otherwise(0), F.when(label, 0).otherwise(metric)
    sums = {"i": F.sum(i), "r": F.sum(r), "i_all": F.sum(F.abs(i)).cast("double"), "r_all": F.sum(F.abs(r)).cast("double")}
    cells = cut_lineage(df.groupBy(*dimension_cols).agg(*[v.alias(n) for n, v in sums.items()]))
    both = cells.agg(F.sum("i").alias("i"), F.sum("r").alias("r"))
    ti, tr = (abs(float(x or 0)) for x in both.first())
    # A little less than asked for, as these sums are in doubles; the report decides exactly.
    enough = F.greatest(F.try_divide(F.sum("i_all"), F.lit(ti)), F.try_divide(F.sum("r_all"), F.lit(tr))) >= min_support * (1 - 1e-9)

    def supported(each: DataFrame, *by: str) -> list[tuple]:
        return sorted(tuple(row) for row in each.groupBy(*by).agg(enough.alias("enough")).filter("enough").select(*by).collect())

    def merged(columns: dict[str, Column]) -> DataFrame:
        return cells.select(*[c.alias(n) for n, c in columns.items()], *sums).groupBy(*columns).agg(
            *[F.sum(c).alias(c) for c in sums])

    names = F.array(*[_named(d) for d in dimension_cols])
    values = [value for value, in supported(
        cells.select("i_all", "r_all", explode_once(names).alias("value")).filter("value IS NOT NULL"), "value")]
    # Cells that agree in their supported values are one. A value's number is its place among all, from 0.
    cells = merged({"items": F.array_distinct(F.array_compact(F.array(*[
        _number(_named(d), [(v, n) for n, v in enumerate(values) if v.startswith(f"{d}=")]) for d in dimension_cols])))})
    cells = cut_lineage(cells.filter(F.size("items") > 0).withColumn("inside", F.col("items")))
    segments = [(n,) for n in range(len(values))]
    named, levels = [], []
    while segments:
        named += [(len(levels), n, sorted(values[v] for v in segment)) for n, segment in enumerate(segments)]
        levels.append(cells.select(F.lit(len(levels)).alias("level"), F.explode("inside").alias("segment"), "i", "r"))
        if len(levels) == len(dimension_cols):
            break
        lasts = _int_array(segment[-1] for segment in segments)

        def after(segment: Column, lasts: Column = lasts) -> Column:
            """The cell's values after the segment's last one."""
            at = F.array_position("items", F.get(lasts, segment)).cast("int")
            return F.slice("items", at + 1, F.size("items"))

        each = cells.select("i_all", "r_all", "items", F.explode("inside").alias("segment"))
        pairs = supported(each.select("i_all", "r_all", "segment", F.explode(after(F.col("segment"))).alias("item")),
                          "segment", "item")
        if not pairs:
            break
        longer = [(*segments[segment], item) for segment, item in pairs]
        growing = {"items": _int_array(sorted({v for segment in longer for v in segment})),
                   "inside": _int_array(sorted({segment for segment, _ in pairs}))}
        codes = F.lit([segment * len(values) + item for segment, item in pairs]).cast("array<bigint>")
        cells = merged({c: F.array_intersect(c, kept) for c, kept in growing.items()}).filter(F.size("inside") > 0)
        grown = F.flatten(F.transform("inside", lambda segment: F.transform(
            after(segment), lambda item: F.array_position(codes, segment.cast("bigint") * len(values) + item))))
        cells = cut_lineage(cells.withColumn("inside", F.transform(
            F.filter(grown, lambda at: at > 0), lambda at: (at - 1).cast("int"))).filter(F.size("inside") > 0))
        segments = longer
    each = reduce(DataFrame.union, levels or [cells.select(
        F.lit(0).alias("level"), F.explode("inside").alias("segment"), "i", "r")])
    found = each.groupBy("level", "segment").agg(F.sum("i").alias("metric_interest"), F.sum("r").alias("metric_reference"))
    drivers = spark.createDataFrame(named, "level int, segment int, drivers array<string>")
    totals = both.select(F.struct("i", "r")).scalar()
    return segment_report(found.join(drivers, ["level", "segment"]).drop("level", "segment"), totals, top_k, min_support)


def _number(value: Column, numbers: list[tuple[str, int]]) -> Column:
    """The number of a value among ``numbers``, NULL if it has none."""
    if not numbers:
        return F.lit(None).cast("int")
    known, number = zip(*numbers)
    return F.get(_int_array(number), (F.array_position(F.lit(list(known)), value) - 1).cast("int"))


def _int_array(values: Iterable[int]) -> Column:
    return F.lit(list(values)).cast("array<int>")


def causal_effect(df: DataFrame, data_col: str, timestamp_col: str, intervention: Column,
                  series_cols: Sequence[str] = (), step_days: int = 1, season: int | None = None,
                  output_time_series: bool = False) -> DataFrame:
    """Difference between what followed ``intervention`` and the projected earlier course."""
    before = F.col(timestamp_col) < intervention
    fitted = with_fit(df, data_col, timestamp_col, before, series_cols, step_days, season)
    y = F.col(data_col).cast("double")
    if output_time_series:
        running = (Window.partitionBy(*series_cols).orderBy(timestamp_col)
                   .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        point = F.when(before, F.lit(None)).otherwise(y - F.col("_expected"))
        return fitted.select(
            *series_cols, F.col(timestamp_col), y.alias(data_col),
            F.col("_expected").alias("counterfactual"), point.alias("point_effect"),
            F.sum(point).over(running).alias("cumulative_effect"))
    model = ["_n", "_x_mean", "_sxx", "_sigma"]
    after = fitted.filter(~before).groupBy(*series_cols).agg(
        F.sum(y - F.col("_expected")).alias("absolute_effect"),
        F.sum("_expected").alias("_counterfactual"), F.count(y).alias("_m"),
        F.avg("_x").alias("_x_after"), *[F.max(c).alias(c) for c in model])
    m = F.col("_m")
    lever = F.lit(1.0) / F.col("_n") + F.try_divide(F.pow(F.col("_x_after") - F.col("_x_mean"), 2), F.col("_sxx"))
    error = F.col("_sigma") * F.sqrt(m + m * m * lever)
    probability = two_sided_probability(ratio(F.col("absolute_effect"), error))
    return after.select(
        *series_cols, probability.alias("prob_causal_effect"), (1.0 - probability).alias("p_value"),
        "absolute_effect", ratio(F.col("absolute_effect"), F.col("_counterfactual")).alias("relative_effect"))


def correlation(df: DataFrame, target_col: str, correlation_cols: Sequence[str],
                segment_cols: Sequence[str] = (), method: str = "pearson") -> DataFrame:
    """corr_col, target_col, correlation, segment_size: one row per column (and segment).

    All columns come from one aggregate; rows with a NULL in a pair do not count.
    """
    if method == "spearman":
        # The target is ranked anew only for columns that lack some of its rows.
        df = cut_lineage(df.select(*segment_cols, target_col, *correlation_cols).filter(F.col(target_col).isNotNull()))
        gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in correlation_cols]).first()
        ranked_once = cut_lineage(average_ranks(df, target_col, segment_cols, "_rt"))
        out = None
        for c in correlation_cols:
            base = ranked_once if not gaps[c] else average_ranks(
                df.filter(F.col(c).isNotNull()), target_col, segment_cols, "_rt")
            rows = average_ranks(base, c, segment_cols, "_rc").groupBy(*segment_cols).agg(
                F.lit(c).alias("corr_col"), F.lit(target_col).alias("target_col"),
                F.corr("_rt", "_rc").alias("correlation"), F.count(F.lit(1)).alias("segment_size"))
            out = rows if out is None else out.unionByName(rows)
        return out
    target = F.col(target_col).cast("double")
    pairs = F.array(*[
        F.struct(F.lit(c).alias("corr_col"), F.lit(target_col).alias("target_col"),
                 F.col(f"_r_{i}").alias("correlation"), F.col(f"_n_{i}").alias("segment_size"))
        for i, c in enumerate(correlation_cols)])
    aggregates = []
    for i, c in enumerate(correlation_cols):
        value = F.col(c).cast("double")
        aggregates += [F.corr(target, value).alias(f"_r_{i}"), F.count(target + value).alias(f"_n_{i}")]
    return df.groupBy(*segment_cols).agg(*aggregates).select(
        *segment_cols, F.explode(pairs).alias("_p")).select(*segment_cols, "_p.*")


def average_ranks(df: DataFrame, col: str, segment_cols: Sequence[str], name: str) -> DataFrame:
    """Add the average rank of ``col`` within its segment, without sorting a segment in one task.

    Ties are counted first, so a value shared by a third of the rows is one row.
    The distinct values are range-partitioned and written, which fixes the
    partitioning, and partition totals (one row per partition and segment) carry
    the count over.
    """
    keys = [*segment_cols, col]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_ties"))
    fixed = cut_lineage(counted.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()))
    sizes = fixed.groupBy(*segment_cols, "_part").agg(F.sum("_ties").alias("_size"))
    earlier = Window.partitionBy(*segment_cols).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*segment_cols, "_part",
                           F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_off"))
    inside = (Window.partitionBy(*segment_cols, "_part").orderBy(col)
              .rowsBetween(Window.unboundedPreceding, -1))
    ranks = join_null_safe(fixed.withColumn("_before", F.coalesce(F.sum("_ties").over(inside), F.lit(0))),
                           offsets, [*segment_cols, "_part"]).select(
        *keys, (F.col("_off") + F.col("_before") + (F.col("_ties") + 1) / 2.0).alias(name))
    return join_null_safe(df, ranks, keys)
