"""Feature table: one row per machine and hour with a complete look-back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foresight import schema as S
from foresight.functions.columns import HOUR_US, block_of, clip, coerce, fill_midrange
from foresight.operators.asof import DAY_US
from foresight.operators.blocks import BLOCK, BLOCK_HOURS, OWN, US, block_size, rows_before, spread
from foresight.operators.windows import ROWS_UP_TO, UP_TO, dedup_last, ffill, over, rolling_columns, with_expressions
from foresight.schema import KEY, LABEL, TS, PlantTables
from foresight.session import small_methods

# what a row is: a reading, or the place of its code in the list of errors, services or failed components
_READING = 0
_SERVICE = _READING + len(S.ERROR_IDS)
_FAILURE = _SERVICE + len(S.COMPONENTS) + 1
_US = f"unix_micros(CAST({TS} AS TIMESTAMP))"
PLACE = "_place"


def with_seq(telemetry: DataFrame) -> DataFrame:
    """Telemetry with an order of arrival; tables without one hold unique readings."""
    return telemetry if "seq" in telemetry.columns else telemetry.withColumn("seq", F.lit(0).cast("bigint"))


def maint_with_failures(maint: DataFrame, failures: DataFrame | None) -> DataFrame:
    """Services and failures (a failed component is replaced), without repeats."""
    services = maint.select(TS, KEY, "comp")
    if failures is None:
        return services.distinct()
    return services.unionByName(failures.select(TS, KEY, F.col("failure").alias("comp"))).distinct()


def clean_telemetry(telemetry: DataFrame) -> DataFrame:
    """Last reading per hour, short gaps carried forward, the rest mid-range, limited to the soft bounds."""
    columns = [KEY, TS, "seq", *S.SENSORS]
    numeric = with_seq(telemetry).select(*columns).withColumns({s: coerce(s) for s in S.SENSORS})
    filled = ffill(dedup_last(numeric, [KEY, TS], "seq"), KEY, TS, S.SENSORS, S.FFILL_ROWS)
    return filled.withColumns({s: clip(fill_midrange(s, *S.SOFT_BOUNDS[s]), *S.SOFT_BOUNDS[s]) for s in S.SENSORS}
                              ).drop("seq")


def _copies(t: PlantTables, floor_errors: bool, size: int, back: int, ahead: int) -> DataFrame:
    """Every reading and event of a known code, in its own block and in those that look back (or ahead) at it."""
    def events(df: DataFrame, first: int, codes, code: str, when: str = TS, least: int = 1) -> DataFrame:
        number = f"coalesce(array_position(array('{"', '".join(codes)}'), {code}), 0L)"
        nothing = [f"CAST(NULL AS DOUBLE) AS {s}" for s in S.SENSORS]
        return df.where(f"{number} >= {least}").selectExpr(
            KEY, f"{when} AS {TS}", f"CAST({first} + {number} AS INT) AS code", "CAST(NULL AS BIGINT) AS seq", *nothing)

    readings = with_seq(t.telemetry).selectExpr(
        KEY, TS, f"{_READING} AS code", "seq", *[f"nullif(try_cast({s} AS DOUBLE), double('NaN')) AS {s}" for s in S.SENSORS])
    hour = f"CAST(date_trunc('hour', {TS}) AS TIMESTAMP_NTZ)" if floor_errors else TS
    parts = readings.union(events(t.errors, _READING, S.ERROR_IDS, "errorID", hour)).union(events(t.maint, _SERVICE, S.COMPONENTS, "comp"))
    if t.failures is not None:
        parts = parts.union(events(t.failures, _FAILURE, S.COMPONENTS, "failure", least=0))  # one of another code is a failure too
    timed = parts.where(f"{TS} IS NOT NULL").withColumn(US, F.expr(_US))
    return spread(
        timed, size,
        back=F.expr(f"CASE WHEN code <= {_SERVICE} THEN {back}L ELSE 0L END"),
        ahead=F.expr(f"CASE WHEN code >= {_FAILURE} THEN {ahead}L ELSE 0L END"),
    ).drop(US, OWN)


def _observations(copies: DataFrame, keys: list[str], size: int) -> DataFrame:
    """One row per (machine, time) of a block: one aggregation deduplicates readings, counts errors and merges repeated services."""
    aggregates = {
        "readings": f"count_if(code = {_READING})",
        **{s: f"max_by({s}, seq)" for s in S.SENSORS},
        **{e: f"count_if(code = {_READING + 1 + i})" for i, e in enumerate(S.ERROR_IDS)},
        **{c: f"count_if(code IN ({_SERVICE + 1 + i}, {_FAILURE + 1 + i}))" for i, c in enumerate(S.COMPONENTS)},
        "failed": f"count_if(code >= {_FAILURE})",
    }
    merged = copies.groupBy(*keys, BLOCK, TS).agg(*[F.expr(f"{e} AS {c}") for c, e in aggregates.items()])
    placed = merged.withColumn(US, F.expr(_US)).withColumn(OWN, F.col(BLOCK) == block_of(F.col(US), size))
    return placed.selectExpr(
        *keys, TS, US, BLOCK, OWN, "readings", *S.SENSORS,
        *[f"CASE WHEN readings > 0 THEN {e} END AS {e}" for e in S.ERROR_IDS],
        *[f"CASE WHEN {c} > 0 THEN {US} END AS {c}" for c in (*S.COMPONENTS, "failed")],
    ).where(f"readings > 0 OR coalesce(failed, {', '.join(S.COMPONENTS)}) IS NOT NULL")


def _earlier(copies: DataFrame, keys: list[str], size: int, back: int) -> DataFrame:
    """The last readings before the look-back of each block. A block's copies hold the region behind it up to the next block's
    look-back, so its last readings are found where the copies lie, and only these leave."""
    ends = f"code = {_READING} AND {_US} < ({BLOCK} + 1) * {size}L - {back}L"
    newest = f"dense_rank() OVER (PARTITION BY {', '.join(keys)}, {BLOCK}, _ends ORDER BY {TS} DESC)"
    last = copies.selectExpr("*", f"{ends} AS _ends").selectExpr("*", f"{newest} AS _rn").where(f"_rn <= {S.FFILL_ROWS}")
    # as an aggregate the condition stays here: moved below the exchange, it would make another one
    merged = last.groupBy(*keys, BLOCK, TS).agg(F.expr("bool_or(_ends) AS _ends"), *[F.expr(f"max_by({s}, seq) AS {s}") for s in S.SENSORS])
    tails = merged.where("_ends").selectExpr(KEY, TS, f"{_US} AS {US}", f"{BLOCK} AS _cut", "1L AS readings", *S.SENSORS)
    return rows_before(tails, KEY, S.FFILL_ROWS)


def _machine_state(t: PlantTables, size: int, back: int) -> DataFrame:
    """One row per (machine, block): attributes, first reading, last service of each component before the block."""
    us = f"{_US} AS {US}"
    parts = t.telemetry.selectExpr(KEY, us, "CAST(NULL AS STRING) AS comp").union(t.maint.selectExpr(KEY, us, "comp"))
    if t.failures is not None:
        parts = parts.union(t.failures.selectExpr(KEY, us, "failure"))
    per_block = parts.where(f"{US} IS NOT NULL").groupBy(KEY, block_of(F.col(US), size).alias(BLOCK)).agg(
        F.expr(f"min(CASE WHEN comp IS NULL THEN {US} END) AS first_us"),
        *[F.expr(f"max(CASE WHEN comp = '{c}' THEN {US} END) AS {c}") for c in S.COMPONENTS])
    before = f"OVER (PARTITION BY {KEY} ORDER BY {BLOCK} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    carried = per_block.selectExpr(
        KEY, BLOCK, f"{BLOCK} * {size}L - {back + 1}L AS {US}", "false AS " + OWN,
        f"min(first_us) OVER (PARTITION BY {KEY}) AS first_us", *[f"max({c}) {before} AS {c}" for c in S.COMPONENTS])
    return carried.join(t.machines.selectExpr(KEY, "model", "CAST(age AS DOUBLE) AS age"), KEY, "left")


def _clean_expression(sensor: str) -> str:
    """Reading, else the last one of the previous rows, else mid-range; limited to the soft bounds."""
    lo, hi = S.SOFT_BOUNDS[sensor]
    near = f"CASE WHEN _rn - _at_{sensor} <= {S.FFILL_ROWS} THEN _last_{sensor} END"
    return f"CASE WHEN readings > 0 THEN least(greatest(coalesce({near}, {(lo + hi) / 2}D), {lo}D), {hi}D) END"


def build_features(
    t: PlantTables, sample_every: int | None = None, horizon_hours: int | None = None,
    windows=S.WINDOW_HOURS, block_hours: int = BLOCK_HOURS, floor_errors: bool = True, only: DataFrame | None = None,
    place: str | None = None,
) -> DataFrame:
    """Features of every (machine, hour) with a full look-back; with a horizon also the failure label.

    Readings, errors, services and failures share one window partitioning by (machine, time block), so a
    machine with a very long or dense history is split over many tasks. Failures, where given, count as services.
    An error is counted at the start of its hour; `floor_errors=False` keeps only errors at the exact reading time.
    `only` names the distinct (machine, block) to build; the others go before the exchange. There is one exchange of
    all readings, by (machine, block): the aggregation and all windows work where it put them. `place` is a function of the
    machine, as SQL, that takes the machine's part in it, so that rows of one place and block come out of one task.
    """
    small_methods(t.telemetry.sparkSession)
    back = max(*windows, S.ERROR_WINDOW_HOURS) * HOUR_US
    ahead = (horizon_hours or 0) * HOUR_US
    size = block_size(block_hours, back, ahead)
    keys = [KEY] if place is None else [KEY, PLACE]

    def exchanged(df: DataFrame) -> DataFrame:
        kept = df if only is None else df.join(only, [KEY, BLOCK], "left_semi").select(*df.columns)
        return kept.repartition(KEY, BLOCK) if place is None else kept.withColumn(PLACE, F.expr(place)).repartition(PLACE, BLOCK)

    every = _copies(t, floor_errors, size, back, ahead)
    copies = exchanged(every)
    earlier = _earlier(copies, keys, size, back) if only is None else _earlier(every, [KEY], size, back)
    # all three come by the same exchange, so that their union needs none
    earlier = exchanged(earlier)
    state = exchanged(_machine_state(t, size, back))
    rows = _observations(copies, keys, size).unionByName(earlier, allowMissingColumns=True).unionByName(state, allowMissingColumns=True)

    numbered = with_expressions(rows, {"_rn": f"sum(CASE WHEN readings > 0 THEN 1 ELSE 0 END) {over(keys, ROWS_UP_TO)}"})
    known = {f"_at_{s}": f"max(CASE WHEN {s} IS NOT NULL THEN _rn END) {over(keys, ROWS_UP_TO)}" for s in S.SENSORS}
    known |= {f"_last_{s}": f"last({s}, true) {over(keys, ROWS_UP_TO)}" for s in S.SENSORS}
    base = [*keys, TS, US, BLOCK, OWN, "readings", *S.ERROR_IDS, *S.COMPONENTS, "failed", "model", "age", "first_us"]
    cleaned = with_expressions(numbered, known).selectExpr(*base, *[f"{_clean_expression(s)} AS {s}" for s in S.SENSORS])
    extra = {f"_since_{c}": f"max({c}) {over(keys, UP_TO)}" for c in S.COMPONENTS}
    extra |= {f"_{c}": f"last({c}, true) {over(keys, UP_TO)}" for c in ("model", "age", "first_us")}
    if horizon_hours:
        extra["_next"] = f"min(failed) {over(keys, f'RANGE BETWEEN 1L FOLLOWING AND {ahead}L FOLLOWING')}"
    rolled = rolling_columns(
        cleaned, keys, S.SENSORS, windows, sums=[(e, S.ERROR_WINDOW_HOURS) for e in S.ERROR_IDS], complete=True, extra=extra)
    complete = rolled.where(f"{OWN} AND readings > 0 AND {US} >= _first_us + {(max(windows) - 1) * HOUR_US}L")
    if sample_every:
        complete = complete.where(f"hour({TS}) % {sample_every} = 0")
    numeric, _ = S.feature_columns(windows)
    source = {c: c for c in numeric}
    source |= {f"{e}_count_{S.ERROR_WINDOW_HOURS}h": f"CAST({e}_sum_{S.ERROR_WINDOW_HOURS}h AS DOUBLE)" for e in S.ERROR_IDS}
    cap = f"{S.DAYS_SINCE_CAP}D"
    source |= {f"days_since_{c}": f"least(coalesce(({US} - _since_{c}) / {float(DAY_US)}D, {cap}), {cap})" for c in S.COMPONENTS}
    source["age"] = "_age"
    finite = "coalesce(CASE WHEN NOT isnan({0}) AND abs({0}) < double('Infinity') THEN {0} END, 0D)"
    label = [f"CASE WHEN _next IS NULL THEN 0 ELSE 1 END AS {LABEL}"] if horizon_hours else []
    return complete.selectExpr(KEY, TS, *[f"{e} AS {c}" for c, e in source.items()], "_model AS model", *label).selectExpr(
        KEY, TS, *[f"{finite.format(c)} AS {c}" for c in numeric], "model", *([LABEL] if horizon_hours else []))


def build_training_table(
    t: PlantTables, sample_every: int | None = S.SAMPLE_EVERY_HOURS, horizon_hours: int = S.HORIZON_HOURS, **options
) -> DataFrame:
    """Features on the training hour grid with the label "fails within the horizon"."""
    return build_features(t, sample_every, horizon_hours, **options)
