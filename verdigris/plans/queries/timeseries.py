"""Positions, frames, sequences, fills and splits over the ordered readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from verdigris.operators.features import lag_features, rolling_features, sensor_features
from verdigris.operators.metrics import trajectory_summary
from verdigris.operators.ordering import number_rows
from verdigris.operators.sequences import (
    chrono_split,
    fill_gaps,
    inference_windows,
    sequence_windows,
)
from verdigris.plans.oracle import (
    LAG_NAMES,
    ROLLING_NAMES,
    lag_sql,
    replace_rounded,
    rolling_sql,
    round_sql,
    using,
    windows_sql,
)
from verdigris.plans.registry import Tables, query, rounded
from verdigris.schemas import ACTUATOR_NAMES, INDICATORS, MEASURES

_AVERAGES = [n for n in ROLLING_NAMES if "_avg_" in n]
_KEYS = 'reading_id, "timestamp"'


@query("row_number_global", using("numbered", f"select {_KEYS}, position from numbered"))
def _(t: Tables):
    return t.numbered()


@query("lag_features", using("features", f"select {_KEYS}, {', '.join(LAG_NAMES)} from features"))
def _(t: Tables):
    return lag_features(t.fact)


@query("rolling_features", using("features", f"select {_KEYS}, {round_sql(ROLLING_NAMES)} from features"))
def _(t: Tables):
    return rounded(rolling_features(t.fact))


@query("sensor_features", using("features", f"select {replace_rounded(_AVERAGES)} from features"))
def _(t: Tables):
    return rounded(sensor_features(t.fact))


_BY_DEVICE = "partition by device_id"


@query(
    "sensor_features_by_device",
    using(
        "base",
        f"select {replace_rounded(_AVERAGES)} from (select *, {lag_sql('o')}, {rolling_sql('s', 'l')} "
        f"from base {windows_sql(_BY_DEVICE)})",
    ),
)
def _(t: Tables):
    """Every device is a series of its own."""
    return rounded(sensor_features(t.device_fact, partition_by=("device_id",)))


# Windows are compared by first and last step, sum, and a sum weighted by step, of each input.
_STEPS = "window w as (order by position rows between 24 preceding and 1 preceding)"
_WINDOWED = ["tds_level", "air_temperature", "air_humidity"]


def _digest_sql(c: str) -> str:
    weighted = f"sum((position + 1) * {c}) over w - (first_value(position) over w) * (sum({c}) over w)"
    return (
        f"round(first_value({c}) over w + 1.3e-8, 6) as first_{c}, round(last_value({c}) over w + 1.3e-8, 6) as last_{c}, "
        f"round(sum({c}) over w + 1.3e-8, 6) as sum_{c}, round({weighted} + 1.3e-8, 4) as weighted_{c}"
    )


def _step_values(i: int):
    """Input ``i`` of each step of a window."""
    return F.transform("x", lambda row: row[i].cast("double"))


def _digest(values, c: str) -> list:
    """First, last, sum and weighted sum of an array of numbers."""
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    weighted = F.aggregate(F.transform(values, lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, v: a + v)
    return [
        *[F.round(v + F.lit(1.3e-8), 6).alias(f"{n}_{c}") for n, v in (("first", values[0]), ("last", values[23]), ("sum", total))],
        F.round(weighted + F.lit(1.3e-8), 4).alias(f"weighted_{c}"),
    ]


@query(
    "sequence_windows",
    using(
        "numbered",
        "select * exclude (n) from (select position - 24 as sample, count(*) over w as n, round(ph_level + 1.3e-8, 6) as y, "
        + ", ".join(_digest_sql(c) for c in _WINDOWED)
        + f" from numbered {_STEPS}) where n = 24",
    ),
)
def _(t: Tables):
    """24 steps of TDS, air temperature and humidity, and the pH that follows."""
    windows = sequence_windows(t.numbered(*_WINDOWED, "ph_level"), _WINDOWED, 24, "ph_level")
    digests = [x for i, c in enumerate(_WINDOWED) for x in _digest(_step_values(i), c)]
    return windows.select("sample", F.round(F.col("y") + F.lit(1.3e-8), 6).alias("y"), *digests)


@query(
    "sequence_windows_horizon",
    using(
        "numbered",
        """select position - 14 as sample, round(a + 1.3e-8, 6) as y_first, round(tds_level + 1.3e-8, 6) as y_last, n as horizon from (
           select position, tds_level, first_value(tds_level) over w as a, count(*) over w as n from numbered
           window w as (order by position rows between 2 preceding and current row)) where position >= 14""",
    ),
)
def _(t: Tables):
    """All numeric inputs are targets, three steps ahead."""
    inputs = ["tds_level", "air_temperature"]
    windows = sequence_windows(t.numbered(*inputs), inputs, 12, horizon=3)
    return rounded(
        windows.select(
            "sample",
            F.col("y")[0][0].alias("y_first"),
            F.col("y")[2][0].alias("y_last"),
            F.size("y").cast("bigint").alias("horizon"),
        )
    )


@query(
    "inference_windows",
    using(
        "numbered",
        "select * exclude (n) from (select position, reading_id, position - 24 as sample, count(*) over w as n, "
        + ", ".join(f"round(sum(f_{c}) over w, 3) as sum_{c}, f_last_{c}" for c in MEASURES)
        + " from (select *, "
        + ", ".join(f"lag(f_{c}) over (order by position) as f_last_{c}" for c in MEASURES)
        + " from (select *, "
        + ", ".join(f"cast(coalesce(cast({c} as float), 0) as double) as f_{c}" for c in MEASURES)
        + f" from numbered)) {_STEPS}) where n = 24",
    ),
)
def _(t: Tables):
    """Every measure as an input, compared by its sum and its last step."""
    windows = inference_windows(t.numbered(*MEASURES), MEASURES, 24, keep=["position", "reading_id"])
    columns = []
    for i, c in enumerate(MEASURES):
        total = F.aggregate(_step_values(i), F.lit(0.0), lambda a, v: a + v)
        columns += [F.round(total, 3).alias(f"sum_{c}"), F.element_at(_step_values(i), -1).alias(f"f_last_{c}")]
    return windows.select("position", "reading_id", "sample", *columns)


_FILLED = [*MEASURES, *[state for _, _, state in ACTUATOR_NAMES.values()], *INDICATORS]


@query(
    "fill_ffill_bfill",
    using(
        "base",
        f"select {_KEYS}, "
        + ", ".join(
            f"coalesce(last_value({c} ignore nulls) over (order by {o} rows between unbounded preceding and current row), "
            f"first_value({c} ignore nulls) over (order by {o} rows between current row and unbounded following), 0) as {c}"
            for c in _FILLED
            for o in ('"timestamp", reading_id',)
        )
        + " from base",
    ),
)
def _(t: Tables):
    rows = t.base.select("reading_id", "timestamp", *_FILLED)
    return fill_gaps(rows, _FILLED, ["timestamp", "reading_id"])


@query(
    "chrono_split",
    using(
        "numbered",
        f"""select {_KEYS}, position, position < cast(floor((select count(*) from numbered) * 0.8e0) as bigint)
            as is_train from numbered""",
    ),
)
def _(t: Tables):
    rows = t.base.select("reading_id", "timestamp")
    numbered = number_rows(rows, ["timestamp", "reading_id"], total="total")
    return chrono_split(numbered, F.col("total"), index="position").drop("total")


_ORDERED = "struct_pack(a := timestamp_key, b := reading_id)"


@query(
    "trajectory_summary",
    using(
        "stg",
        """select reading_date, count(*) as steps,
           cast(sum(case when is_environment_optimal then 1 else 0 end) as bigint) as optimal_steps, """
        + ", ".join(
            f"arg_{end}_null({c}, {_ORDERED}) as {name}_{c}"
            for end, name in (("min", "first"), ("max", "last"))
            for c in MEASURES
        )
        + " from stg group by reading_date",
    ),
)
def _(t: Tables):
    order = F.struct("timestamp_key", "reading_id")
    return trajectory_summary(t.staged, [F.col("reading_date")], order, MEASURES, F.col("is_environment_optimal"))
