"""Twelve-week category forecasts, rolling-origin backtests and what is derived from them.

Two models share every other step: an exact linear trend and an additive season
model, both from grouped sums and built-in functions. A series holds one row per
calendar week, whatever the sales volume.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larderline.operators.additive_model import INTERVAL_Z, SEASON, TREND, dealt, features, fold_sums, places, predicted, solved, systems
from larderline.plans.demand import demand_shares, eligible_series

HORIZON_WEEKS = 12
HISTORY_CAP = 3.0
ALL_CLUSTERS = "all"
EPOCH = "1970-01-01"

# Backtest windows in days.
INITIAL_DAYS = 294
PERIOD_DAYS = 28
FOLD_HORIZON_DAYS = 28

# Public holidays, each with a window of one extra day.
HOLIDAYS = [
    ("New Year's Day", date(2023, 1, 1)),
    ("Australia Day", date(2023, 1, 26)),
    ("Good Friday", date(2023, 4, 7)),
    ("Easter Monday", date(2023, 4, 10)),
    ("Anzac Day", date(2023, 4, 25)),
    ("Queen's Birthday", date(2023, 6, 12)),
    ("Christmas Day", date(2023, 12, 25)),
    ("Boxing Day", date(2023, 12, 26)),
]
HOLIDAY_WINDOW_DAYS = 1

# Error grades, upper bounds in percent.
GRADES = [(25.0, "Excellent"), (60.0, "Acceptable"), (100.0, "Poor")]
WORST_GRADE = "Unreliable"


def epoch_day(column: Column) -> Column:
    return F.datediff(column, F.lit(EPOCH).cast("date")).cast("bigint")


def easter_sunday(year: int) -> date:
    """Gregorian Easter: the Sunday after the full moon of spring by the church's calendar."""
    golden, century = year % 19, year // 100
    moon = (century - century // 4 - (8 * century + 13) // 25 + 19 * golden + 15) % 30
    moon -= moon // 28 * (1 - 29 // (moon + 1) * ((21 - golden) // 11))
    days = moon - (year + year // 4 + moon + 2 - century + century // 4) % 7
    return date(year, 3, 28) + timedelta(days=days)


def holiday_in(name: str, given: date, year: int) -> date:
    """A holiday in another year: Easter moves with the moon, the birthday is the second Monday of June."""
    if name == "Good Friday":
        return easter_sunday(year) - timedelta(days=2)
    if name == "Easter Monday":
        return easter_sunday(year) + timedelta(days=1)
    if name == "Queen's Birthday":
        return date(year, 6, 14) - timedelta(days=date(year, 6, 14).weekday())
    return given.replace(year=year)


def holiday_days(years: Sequence[int] | None = None) -> list[tuple[str, int, date]]:
    """(holiday, offset, day) for every day in a holiday window; ``years`` gives the dates in other years."""
    dates = [(n, holiday_in(n, d, y)) for y in years for n, d in HOLIDAYS] if years is not None else HOLIDAYS
    return [(n, k, d + timedelta(days=k)) for n, d in dates for k in range(HOLIDAY_WINDOW_DAYS + 1)]


def holiday_features(weekly: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """(week_start, holiday, day_offset) for every week date that falls in a holiday window.

    The calendar rows are a few per year, bounded by the years asked for.
    """
    calendar = weekly.sparkSession.createDataFrame(
        holiday_days(years), "holiday string, day_offset int, holiday_day date"
    )
    weeks = weekly.select("week_start").distinct()
    return weeks.join(F.broadcast(calendar), F.col("week_start") == F.col("holiday_day")).drop("holiday_day")


def future_date(last_week: Column, step: Column, anchor: str) -> Column:
    """The step-th forecast day: Sundays after the last week (default), or the following Mondays."""
    if anchor == "sunday":
        return F.date_add(F.next_day(last_week, "Sunday"), (step - 1) * 7)
    return F.date_add(last_week, step * 7)


def future_frame(weekly: DataFrame, horizon: int = HORIZON_WEEKS, anchor: str = "sunday") -> DataFrame:
    """(category, step, forecast_date): the days to forecast, after each category's last week."""
    last = weekly.groupBy("category").agg(F.max("week_start").alias("last_week"))
    return _with_future(last, horizon, anchor).select("category", "step", "forecast_date")


def _with_future(df: DataFrame, horizon: int, anchor: str) -> DataFrame:
    steps = df.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return steps.withColumn("forecast_date", future_date(F.col("last_week"), F.col("step"), anchor))


def _clipped(value: Column, cap: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(value, cap))


def line_sums(when: Column | None = None) -> list[Column]:
    """Exact sums of a straight-line fit of total_quantity on the week's day number."""
    def only(value: Column) -> Column:
        return value if when is None else F.when(when, value)

    t, y = epoch_day(F.col("week_start")), F.col("total_quantity")
    wide = "decimal(19,0)"
    return [
        F.count(only(y)).alias("n"),
        F.sum(only(t)).alias("st"),
        F.sum(only(y)).alias("sy"),
        F.sum(only(t * t)).alias("stt"),
        F.sum(only((t.cast(wide) * y.cast(wide)).cast("decimal(38,0)"))).alias("sty"),
        F.sum(only((y.cast(wide) * y.cast(wide)).cast("decimal(38,0)"))).alias("syy"),
    ]


def _line() -> dict[str, Column]:
    """Slope, centre and residual spread from :func:`line_sums`; products are exact, one division each."""
    n, st, sy = F.col("n"), F.col("st"), F.col("sy")

    def cross(total: str, a: Column, b: Column) -> Column:
        scaled = (n.cast("decimal(9,0)") * F.col(total).cast("decimal(29,0)")).cast("decimal(38,0)")
        product = (a.cast("decimal(19,0)") * b.cast("decimal(19,0)")).cast("decimal(38,0)")
        return (scaled - product).cast("double")

    xx, xy, yy = cross("stt", st, st), cross("sty", st, sy), cross("syy", sy, sy)
    left_over = F.greatest(yy - F.try_divide(xy * xy, xx), F.lit(0.0))
    return {
        "slope": F.try_divide(xy, xx),
        "t_mean": F.try_divide(st.cast("double"), n.cast("double")),
        "y_mean": F.try_divide(sy.cast("double"), n.cast("double")),
        "sigma": F.sqrt(F.try_divide(left_over, (n * (n - 2)).cast("double"))),
    }


def trend_forecast(weekly: DataFrame, horizon: int = HORIZON_WEEKS, anchor: str = "sunday") -> DataFrame:
    """Linear-trend forecast per category: yhat with an 80 % band, capped at 0 and three times the peak."""
    fitted = (
        eligible_series(weekly)
        .groupBy("category")
        .agg(*line_sums(), F.max("week_start").alias("last_week"), F.max("total_quantity").alias("peak"))
        .withColumns(_line())
    )
    ahead = _with_future(fitted, horizon, anchor)
    trend = F.col("y_mean") + F.col("slope") * (epoch_day(F.col("forecast_date")).cast("double") - F.col("t_mean"))
    cap = F.col("peak").cast("double") * HISTORY_CAP
    band = F.col("sigma") * INTERVAL_Z
    return ahead.withColumn("trend", trend).select(
        "forecast_date",
        "category",
        F.lit(ALL_CLUSTERS).alias("store_cluster"),
        _clipped(F.col("trend"), cap).alias("yhat"),
        _clipped(F.col("trend") - band, cap).alias("yhat_lower"),
        _clipped(F.col("trend") + band, cap).alias("yhat_upper"),
        "trend",
    )


def folds(weekly: DataFrame) -> DataFrame:
    """Weekly rows once per backtest fold: (category, cutoff, week_start, total_quantity, is_train).

    Cutoffs step back by 28 days from 28 days before the last week, while at
    least 294 days of history remain before them.
    """
    series = Window.partitionBy("category")
    room = F.datediff("_last", "_first") - INITIAL_DAYS - FOLD_HORIZON_DAYS
    steps = F.floor(room / PERIOD_DAYS).cast("int")
    return (
        weekly.select("category", "week_start", "total_quantity")
        .withColumn("_first", F.min("week_start").over(series))
        .withColumn("_last", F.max("week_start").over(series))
        .filter(room >= 0)
        .withColumn("_fold", F.explode(F.sequence(F.lit(0), steps)))
        .withColumn("cutoff", F.date_sub(F.col("_last"), F.col("_fold") * PERIOD_DAYS + FOLD_HORIZON_DAYS))
        .filter(F.datediff("week_start", "cutoff") <= FOLD_HORIZON_DAYS)
        .withColumn("is_train", F.col("week_start") <= F.col("cutoff"))
        .drop("_first", "_last", "_fold")
    )


def trend_backtest(weekly: DataFrame) -> DataFrame:
    """(category, cutoff, week_start, y, yhat) of the linear trend on every held-out week."""
    # At most the weeks of one fold horizon; collect_list skips the NULLs of training rows.
    held_out = F.collect_list(F.when(~F.col("is_train"), F.struct("week_start", "total_quantity")))
    fitted = (
        folds(eligible_series(weekly))
        .groupBy("category", "cutoff")
        .agg(*line_sums(F.col("is_train")), held_out.alias("held_out"))
        .withColumns(_line())
    )
    week = F.col("week_start")
    return fitted.select("category", "cutoff", "slope", "t_mean", "y_mean", F.inline("held_out")).select(
        "category",
        "cutoff",
        "week_start",
        F.col("total_quantity").alias("y"),
        (F.col("y_mean") + F.col("slope") * (epoch_day(week).cast("double") - F.col("t_mean"))).alias("yhat"),
    )


def accuracy(backtest: DataFrame) -> DataFrame:
    """(category, mape, rmse, n_folds): errors per horizon, then averaged over the horizons.

    Weeks without sales have no percentage error and only count in the RMSE.
    """
    miss = F.col("yhat") - F.col("y")
    by_horizon = backtest.groupBy("category", F.datediff("week_start", "cutoff").alias("ahead")).agg(
        F.avg(F.when(F.col("y") != 0, F.abs(miss) / F.col("y"))).alias("ape"),
        F.sqrt(F.avg(miss * miss)).alias("rmse"),
        F.countDistinct("cutoff").alias("n_folds"),
    )
    return by_horizon.groupBy("category").agg(
        F.round(F.avg("ape") * 100, 2).alias("mape"),
        F.round(F.avg("rmse"), 2).alias("rmse"),
        F.max("n_folds").alias("n_folds"),
    )


def grade(mape: Column) -> Column:
    chain = F.when(mape < GRADES[0][0], GRADES[0][1])
    for bound, name in GRADES[1:]:
        chain = chain.when(mape < bound, name)
    return F.when(mape.isNotNull(), chain.otherwise(WORST_GRADE))


def failure_modes(category: Column, mape: Column, n_weeks: Column, zero_weeks: Column) -> Column:
    """Known weaknesses of a category's forecast as a JSON list of sentences."""
    zero_percent = zero_weeks * 100 / n_weeks
    found = F.array_compact(
        F.array(
            F.when(
                mape > 25,
                F.concat(F.lit("High forecast error (MAPE "), mape.cast("string"), F.lit("%) — treat with caution.")),
            ),
            F.when(n_weeks < 40, F.format_string("Limited history (%d weeks). Higher uncertainty.", n_weeks)),
            F.when(
                zero_percent > 10,
                F.format_string(
                    "Zero-sales rate %d%% — stockouts may suppress true demand.", F.bround(zero_percent, 0).cast("int")
                ),
            ),
            F.when(category == "fresh_produce", F.lit("Fresh produce sensitive to weather/promotions not in model.")),
        )
    )
    none = F.array(F.lit("No known failure modes detected."))
    return F.to_json(F.when(F.size(found) == 0, none).otherwise(found))


def model_metadata(weekly: DataFrame, accuracies: DataFrame) -> DataFrame:
    """One row per forecast category: errors, backtest status, history length, failure modes."""
    series = (
        eligible_series(weekly)
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("n_weeks"), F.count_if(F.col("total_quantity") == 0).alias("zero_weeks"))
    )
    joined = series.join(accuracies, "category", "left")
    status = F.when(F.col("n_folds") > 0, "success").otherwise(
        "failed: history is shorter than the initial window plus one horizon"
    )
    modes = failure_modes(F.col("category"), F.col("mape"), F.col("n_weeks"), F.col("zero_weeks"))
    return joined.select(
        "category",
        F.lit(ALL_CLUSTERS).alias("store_cluster"),
        "mape",
        "rmse",
        status.alias("cv_status"),
        "n_weeks",
        modes.alias("failure_modes"),
    )


def graded_accuracy(metadata: DataFrame) -> DataFrame:
    """(category, mape, rmse, n_weeks, grade), best first, failed backtests last."""
    return metadata.select("category", "mape", "rmse", "n_weeks", grade(F.col("mape")).alias("grade")).orderBy(
        F.asc_nulls_last("mape"), "category"
    )


def model_performance(metadata: DataFrame) -> DataFrame:
    """The performance report: worst error first."""
    return metadata.select("category", "store_cluster", "mape", "rmse", "n_weeks", "failure_modes").orderBy(
        F.desc_nulls_last("mape"), "category"
    )


def _holiday_lists(years: Sequence[int] | None) -> list[list[int]]:
    """Day numbers of each holiday and offset, in order of their names."""
    by_name: dict[tuple[str, int], list[int]] = {}
    for name, offset, when in holiday_days(years):
        by_name.setdefault((name, offset), []).append((when - date(1970, 1, 1)).days)
    return [sorted(by_name[key]) for key in sorted(by_name)]


def _with_features(weekly: DataFrame, holidays: list[list[int]]) -> DataFrame:
    """Weekly rows with their day number, the first, last and span of their series, features ``_f`` and value ``_y``."""
    series, day_ = Window.partitionBy("category"), epoch_day(F.col("week_start"))
    rows = weekly.select(
        "category",
        "week_start",
        day_.alias("_day"),
        F.col("total_quantity").alias("_y"),
        F.min(day_).over(series).alias("_first"),
        F.max(day_).over(series).alias("_last"),
    )
    span = F.greatest(F.col("_last") - F.col("_first"), F.lit(1).cast("bigint"))
    return rows.withColumn("_span", span).withColumn("_f", features(F.col("_day"), F.col("_first"), F.col("_span"), holidays))


def additive_forecast(
    weekly: DataFrame,
    horizon: int = HORIZON_WEEKS,
    anchor: str = "sunday",
    holiday_years: Sequence[int] | None = None,
) -> DataFrame:
    """Additive season model per category, solved from sums of products; same columns as the trend forecast."""
    holidays = _holiday_lists(holiday_years)
    size = TREND + SEASON + len(holidays)
    rows = _with_features(eligible_series(weekly), holidays)
    constants = ["_first", "_last", "_span"]
    sums = dealt(fold_sums(rows.withColumn("_fold", F.lit(0)), ["category"], size, constants), "category")
    peak = F.get("_sums", F.lit(places(size) - 1))["m"].cast("double")
    equations = systems(sums.withColumn("_cap", peak * HISTORY_CAP), size, len(holidays))
    fitted = solved(dealt(equations, "category"), size, len(holidays))
    last_week = F.date_add(F.lit(EPOCH).cast("date"), F.col("_last").cast("int"))
    ahead = _with_future(fitted.withColumn("last_week", last_week), horizon, anchor)
    ahead = ahead.withColumn("_f", features(epoch_day(F.col("forecast_date")), F.col("_first"), F.col("_span"), holidays))
    yhat, band = F.col("_yhat"), F.col("_spread") * INTERVAL_Z
    return ahead.withColumn("_yhat", predicted(F.col("_f"))).select(
        "forecast_date",
        "category",
        F.lit(ALL_CLUSTERS).alias("store_cluster"),
        F.round(_clipped(yhat, F.col("_cap")), 2).alias("yhat"),
        F.round(_clipped(yhat - band, F.col("_cap")), 2).alias("yhat_lower"),
        F.round(_clipped(yhat + band, F.col("_cap")), 2).alias("yhat_upper"),
        F.round(predicted(F.col("_f"), TREND), 2).alias("trend"),
    )


def additive_backtest(weekly: DataFrame, holiday_years: Sequence[int] | None = None) -> DataFrame:
    """(category, cutoff, week_start, y, yhat) of the additive model on every held-out week.

    Fold k ends 28 (k + 1) days before the last week. A week belongs to the training rows of every fold up to its own
    number, which is a running sum, and is held out in at most one.
    """
    holidays = _holiday_lists(holiday_years)
    size = TREND + SEASON + len(holidays)
    rows = _with_features(eligible_series(weekly), holidays)
    age = (F.col("_last") - F.col("_day")).cast("int")
    room = (F.col("_last") - F.col("_first")).cast("int") - INITIAL_DAYS - FOLD_HORIZON_DAYS
    folds_ = F.floor(room / PERIOD_DAYS).cast("int") + 1
    number = F.floor(age / PERIOD_DAYS).cast("int")
    before = Window.partitionBy("category").orderBy("_day")
    numbered = rows.filter(room >= 0).withColumns({"_number": number, "_folds": folds_})
    # The last week before a period of held-out weeks ends the training rows of its fold, also after a gap.
    turn = F.when(F.lag("_number").over(before) != F.col("_number"), F.lag("_number").over(before))
    numbered = numbered.withColumn("_turn", turn).withColumn("_fitted", F.last("_turn", ignorenulls=True).over(before))
    cases = F.array_compact(
        F.array(
            F.when(F.col("_number") > 0, F.struct((F.least("_number", "_folds") - 1).alias("_fold"), F.lit(True).alias("_trains"))),
            F.when(F.col("_number") < F.col("_folds"), F.struct((F.least("_fitted", "_folds") - 1).alias("_fold"), F.lit(False).alias("_trains"))),
        )
    )
    constants = ["_first", "_last", "_span"]
    each = numbered.select("category", "_day", "_y", "_f", *constants, F.inline(cases))
    parts = each.withColumn("_f", F.when(F.col("_trains"), F.col("_f")))
    sums = dealt(fold_sums(parts, ["category"], size, constants), "category", "_fold")
    fitted = solved(dealt(systems(sums, size, len(holidays)), "category", "_fold"), size, len(holidays))
    tested = fitted.select("category", "_beta", "_scale", *constants, F.inline("_tests")).withColumnsRenamed({"g": "_day", "h": "y"})
    on = lambda days: F.date_add(F.lit(EPOCH).cast("date"), days.cast("int"))
    periods = F.floor((F.col("_last") - F.col("_day")) / PERIOD_DAYS) + 1
    made = features(F.col("_day"), F.col("_first"), F.col("_span"), holidays)
    return tested.select(
        "category",
        on(F.col("_last") - periods * PERIOD_DAYS).alias("cutoff"),
        on(F.col("_day")).alias("week_start"),
        F.col("y").cast("bigint").alias("y"),
        predicted(made).alias("yhat"),
    )


def topdown_forecast(forecast: DataFrame, by_cluster: DataFrame) -> DataFrame:
    """Category forecasts split over store clusters by their share of historical units."""
    shares = demand_shares(by_cluster, ["store_cluster"], "total_quantity")
    share = F.try_divide(F.col("units").cast("double"), F.col("category_units").cast("double"))
    split = forecast.drop("store_cluster").join(shares, "category").withColumn("share", share)
    return split.select(
        "forecast_date",
        "category",
        "store_cluster",
        *[(F.col(c) * F.col("share")).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper", "trend")],
    )


def forecast_summary(forecast: DataFrame) -> DataFrame:
    """Mean and peak weekly forecast and mean upper bound per category and cluster."""
    return forecast.groupBy("category", "store_cluster").agg(
        F.avg("yhat").alias("avg_weekly_forecast"),
        F.max("yhat").alias("max_weekly_forecast"),
        F.avg("yhat_upper").alias("forecast_upper_avg"),
    )


def forecast_window(forecast: DataFrame, category: str, as_of: date) -> DataFrame:
    """Forecasts of one category from ``as_of`` on, in date order."""
    return (
        forecast.filter((F.col("forecast_date") >= F.lit(as_of.isoformat()).cast("date")) & (F.col("category") == category))
        .select(
            "forecast_date",
            "category",
            "store_cluster",
            F.col("yhat").alias("forecast_units"),
            F.col("yhat_lower").alias("low_estimate"),
            F.col("yhat_upper").alias("high_estimate"),
        )
        .orderBy("forecast_date", "store_cluster")
    )
