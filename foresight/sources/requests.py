"""Nested JSON scoring requests: building, checking and flattening them as table jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foresight import schema as S
from foresight.functions.columns import HOUR_US, micros, parse_timestamp
from foresight.operators.split import history_slice
from foresight.plans.features import maint_with_failures
from foresight.schema import KEY, TS, PlantTables

# Leaves are read as text so that a wrong type can be told from a missing value.
REQUEST = (
    "machine_id string, model string, age string, "
    f"telemetry array<struct<datetime: string, {', '.join(f'{s}: string' for s in S.SENSORS)}>>, "
    "errors array<struct<datetime: string, errorID: string>>, last_maint map<string, string>"
)


def make_requests(t: PlantTables, as_of, hours: int = S.HISTORY_HOURS) -> DataFrame:
    """(machineID, body): one JSON request per machine with readings in the last `hours` up to as_of.

    A body is one nested value by definition; it holds the readings of one machine in `hours` hours.
    """
    part = history_slice(t, as_of, hours)
    iso = "yyyy-MM-dd'T'HH:mm:ss"

    def text(c: str = TS) -> Column:
        frac = F.date_format(c, "SSSSSS")
        return F.concat(F.date_format(c, iso), F.when(frac != "000000", F.concat(F.lit("."), frac)).otherwise(""))

    # readings of one time stay in the order they came, which parsing reads from the position
    arrival = F.col("seq") if "seq" in part.telemetry.columns else F.lit(0).cast("bigint").alias("seq")
    readings = part.telemetry.groupBy(KEY).agg(
        F.array_sort(F.collect_list(F.struct(text().alias("at"), arrival, F.struct(text().alias(TS), *S.SENSORS).alias("p")))).alias("telemetry"))
    readings = readings.withColumn("telemetry", F.col("telemetry.p"))
    errors = part.errors.groupBy(KEY).agg(
        F.array_sort(F.collect_list(F.struct(text().alias(TS), "errorID"))).alias("errors"))
    last = maint_with_failures(part.maint, part.failures).groupBy(KEY, "comp").agg(F.max(TS).alias(TS))
    services = last.groupBy(KEY).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("comp", text())))).alias("last_maint"))
    joined = readings.join(t.machines.select(KEY, "model", "age"), KEY).join(errors, KEY, "left").join(services, KEY, "left")
    body = F.struct(
        F.col(KEY).alias("machine_id"), "model", "age", "telemetry",
        F.coalesce("errors", F.array().cast(f"array<struct<{TS}: string, errorID: string>>")).alias("errors"),
        F.coalesce("last_maint", F.create_map().cast("map<string, string>")).alias("last_maint"))
    return joined.select(KEY, F.to_json(body, {"ignoreNullFields": "false"}).alias("body"))


def read_requests(df: DataFrame, body: str = "body") -> DataFrame:
    """Add `r`, the parsed request (null where the text is no JSON object).

    It leaves a generator of one row: a filter on its fields would else be moved below and parse the text again for each field."""
    return df.withColumn("r", F.explode(F.array(F.from_json(body, REQUEST))))


def _reasons(limits: S.RequestContract) -> Column:
    """Names of the rules a parsed request `r` breaks."""
    r = F.col("r")
    tel, errors, maint = r["telemetry"], F.coalesce(r["errors"], F.array()), r["last_maint"]
    machine, age = r["machine_id"].try_cast("bigint"), r["age"].try_cast("int")

    def bad(name: str, condition: Column) -> Column:
        return F.when(F.coalesce(condition, F.lit(True)), F.lit(name))

    def any_of(items: Column, test) -> Column:
        return F.coalesce(F.exists(items, test), F.lit(False))

    def out_of_bounds(p: Column) -> Column:
        checks = [(p[s].isNotNull() & ~F.coalesce(p[s].try_cast("double").between(*S.HARD_BOUNDS[s]), F.lit(False)))
                  for s in S.SENSORS]
        return checks[0] | checks[1] | checks[2] | checks[3]

    def has_null(p: Column) -> Column:
        return p["volt"].isNull() | p["rotate"].isNull() | p["pressure"].isNull() | p["vibration"].isNull()

    n = F.size(tel)
    at = F.transform(tel, lambda p: micros(parse_timestamp(p["datetime"])))
    steps = F.zip_with(F.slice(at, 1, F.greatest(n - 1, F.lit(0))), F.slice(at, 2, F.greatest(n - 1, F.lit(0))),
                       lambda a, b: b - a)
    spans = F.exists(steps, lambda d: d.isNull() | (d != HOUR_US))
    empty_rows = F.size(F.filter(tel, has_null))
    last = F.element_at(at, -1)
    times = F.transform(F.map_values(maint), lambda v: micros(parse_timestamp(v)))
    checks = [
        bad("machine_id", ~machine.between(*limits.machine_ids) if limits.machine_ids else machine.isNull()),
        bad("model", ~r["model"].isin(list(S.MODELS))),
        bad("age", ~age.between(*limits.age) if limits.age else age.isNull()),
        bad("history_length", ~n.between(*limits.history) if limits.history else n < 1),
        bad("reading_time", any_of(at, lambda a: a.isNull())),
        bad("reading_value", any_of(tel, out_of_bounds)),
        bad("hourly_order", F.when(n >= 2, spans).otherwise(F.lit(False))),
        bad("missing_readings", F.when(n >= 1, empty_rows > F.floor(n / 4)).otherwise(F.lit(False))),
        bad("error_code", any_of(errors, lambda e: ~F.coalesce(e["errorID"].isin(list(S.ERROR_IDS)), F.lit(False)))),
        bad("error_time", any_of(errors, lambda e: parse_timestamp(e["datetime"]).isNull())),
        bad("component", any_of(F.map_keys(maint), lambda c: ~c.isin(list(S.COMPONENTS)))),
        bad("service_time", any_of(times, lambda v: v.isNull())),
        bad("service_in_future", F.when(n >= 1, any_of(times, lambda v: v > last)).otherwise(F.lit(False))),
    ]
    listed = F.filter(F.array(*checks), lambda c: c.isNotNull())
    return F.when(r.isNull() | tel.isNull(), F.array(F.lit("body"))).otherwise(listed)


def judged_requests(df: DataFrame, body: str = "body", batch: str | None = None,
                    limits: S.RequestContract = S.RequestContract()) -> DataFrame:
    """All requests, parsed (`r`), with the `reasons` they are rejected for (valid: none).

    Every request has a `request_id`: its own, or the hash of its body where it has none.
    With a batch column, a whole batch is rejected when it is larger than the contract allows, names a machine twice or holds an
    invalid request. Counts per batch are combined before the shuffle. Without it the check also runs on streams.
    """
    told = F.coalesce(F.md5(body), F.lit(""))
    df = df.withColumn("request_id", F.coalesce("request_id", told) if "request_id" in df.columns else told)
    checked = read_requests(df, body).withColumn("reasons", _reasons(limits))
    if batch:
        per_machine = checked.groupBy(batch, F.col("r.machine_id").alias("m")).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.size("reasons") > 0).alias("bad"))
        state = per_machine.groupBy(batch).agg(
            F.sum("n").alias("_n"), F.max(F.when(F.col("m").isNotNull(), F.col("n"))).alias("_m"), F.sum("bad").alias("_bad"))
        extra = F.array(
            F.when(F.col("_n") > limits.batch, F.lit("batch_size")) if limits.batch else F.lit(None).cast("string"), F.when(F.col("_m") > 1, F.lit("repeated_machine")),
            F.when((F.col("_bad") > 0) & (F.size("reasons") == 0), F.lit("batch_has_invalid_request")))
        checked = checked.join(state, batch).withColumn(
            "reasons", F.concat("reasons", F.filter(extra, lambda c: c.isNotNull()))).drop("_n", "_m", "_bad")
    return checked


def valid_and_rejected(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): parsed requests, and requests with their `reasons`."""
    ok = F.size("reasons") == 0
    return judged.where(ok).drop("reasons"), judged.where(~ok).drop("r")


def check_requests(df: DataFrame, body: str = "body", batch: str | None = None,
                   limits: S.RequestContract = S.RequestContract()) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) of the judged requests."""
    return valid_and_rejected(judged_requests(df, body, batch, limits))


def parse_requests(parsed: DataFrame, by: str | None = None) -> PlantTables:
    """Flat tables of parsed requests (`r`); offsets are dropped, wall-clock times stay.

    The key is the machine, or with `by` that column, which keeps several requests of one machine apart."""
    key = F.col(by) if by else F.col("r.machine_id").try_cast("bigint")
    r = parsed.select(key.alias(KEY), "r.*")
    telemetry = r.select(KEY, F.posexplode("telemetry").alias("seq", "p")).select(
        parse_timestamp("p.datetime").alias(TS), KEY, F.col("seq").cast("bigint").alias("seq"),
        *[F.col(f"p.{s}").try_cast("double").alias(s) for s in S.SENSORS])
    errors = r.select(KEY, F.explode("errors").alias("e")).select(
        parse_timestamp("e.datetime").alias(TS), KEY, F.col("e.errorID").alias("errorID"))
    maint = r.select(KEY, F.explode("last_maint").alias("comp", "at")).select(
        parse_timestamp("at").alias(TS), KEY, "comp")
    machines = r.select(KEY, "model", F.col("age").try_cast("int").alias("age"))
    return PlantTables(telemetry, errors, maint, None, machines)
