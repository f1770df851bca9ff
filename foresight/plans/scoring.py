"""Scoring the whole plant at one time, and scoring JSON requests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foresight import schema as S
from foresight.operators.split import at_timestamp, history_slice, latest_time
from foresight.operators.windows import latest_per_key
from foresight.plans.features import build_features
from foresight.plans.models import PROBABILITY, Scorer
from foresight.schema import KEY, LABEL, TS, PlantTables
from foresight.session import materialize
from foresight.sources.requests import judged_requests, parse_requests, valid_and_rejected


def features_at(t: PlantTables, as_of=None, hours: int = S.HISTORY_HOURS) -> DataFrame:
    """Feature rows of exactly `as_of` (default: the latest reading) from the last `hours` of history."""
    as_of = latest_time(t.telemetry) if as_of is None else as_of
    return at_timestamp(build_features(history_slice(t, as_of, hours)), as_of)


def score_all(t: PlantTables, scorer: Scorer, as_of=None, hours: int = S.HISTORY_HOURS) -> DataFrame:
    """One row per machine with a complete history at `as_of`, most endangered first."""
    scored = scorer.score(features_at(t, as_of, hours))
    return scored.select(KEY, TS, PROBABILITY, LABEL, "model_version", "model", "age").orderBy(F.desc(PROBABILITY), KEY)


def top_risks(scores: DataFrame, n: int = 10) -> DataFrame:
    return scores.orderBy(F.desc(PROBABILITY), KEY).limit(n)


def request_features(valid: DataFrame, id: str = "request_id") -> DataFrame:
    """Newest feature row of every parsed, valid request that has one, with its `id` and machine.

    Requests are kept apart by id and contents: no request gets the features of another one that came under its id. Rows
    that repeat an id with its contents get a row each from one calculation."""
    keyed = valid.withColumn("_request", F.md5(F.to_json(F.struct(id, "r"), {"ignoreNullFields": "false"})))
    once = keyed.dropDuplicates(["_request"])
    newest = latest_per_key(build_features(parse_requests(once, "_request")), KEY, TS).withColumnRenamed(KEY, "_request")
    machines = keyed.select("_request", id, F.col("r.machine_id").try_cast("bigint").alias(KEY))
    return machines.join(newest, "_request").drop("_request")


def ambiguous_ids(df: DataFrame, body: str = "body", id: str = "request_id") -> DataFrame:
    """Ids under which different bodies came; counted with partial aggregation, so a hot id is no hot task."""
    told = F.coalesce(F.md5(body), F.lit(""))
    return df.groupBy(id).agg(F.min(told).alias("_a"), F.max(told).alias("_b")).where("_a <> _b").select(id)


def score_requests(df: DataFrame, scorer: Scorer, body: str = "body", batch: str | None = None,
                   limits: S.RequestContract = S.RequestContract(), id: str = "request_id",
                   store: Callable[[DataFrame, str], DataFrame] = materialize) -> tuple[DataFrame, DataFrame]:
    """(scored feature rows, refused requests) of a table of JSON requests: every request is in one of them.

    Runs at once: `store` writes the parsed requests and the scores and reads them back, so either is worked out once.
    A valid request without a complete look-back is refused with the reason `no_complete_history`, one whose id also
    stands for another body with `ambiguous_id`: its answer could not be told from the other's."""
    judged = store(judged_requests(df, body, batch, limits), "judged")
    valid, rejected = valid_and_rejected(judged)
    clashes = ambiguous_ids(judged, body, id)
    unclear = valid.join(clashes, id, "left_semi").withColumn("reasons", F.array(F.lit("ambiguous_id")))
    clear = valid.join(clashes, id, "left_anti")
    scored = store(scorer.score(request_features(clear, id)), "scored")
    short = clear.join(scored.select(id).distinct(), id, "left_anti").withColumn("reasons", F.array(F.lit("no_complete_history")))
    refused = [part.select(*rejected.columns) for part in (rejected, unclear, short)]
    return scored, refused[0].unionByName(refused[1]).unionByName(refused[2])
