"""How many runs, and runs of how many tenants, were under way at a time: a sweep over starts and ends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloft.operators.joins import join_small
from gaugeloft.operators.ranks import running_sum

AT, DELTA, LEVEL, BEGIN, END = "_at", "_delta", "_level", "_begin", "_end"


def _steps(runs: DataFrame, group: list[str]) -> DataFrame:
    """By how much the number of runs under way changes at each time, in microseconds, at which one starts or ends.

    Changes that cancel out stay, so every start has an entry.
    """
    both = F.array(*[F.struct(F.col(t).alias(AT), F.lit(d).cast("bigint").alias(DELTA)) for t, d in ((BEGIN, 1), (END, -1))])
    return runs.select(*group, F.explode(both).alias("_e")).groupBy(*group, F.col(f"_e.{AT}").alias(AT)).agg(F.sum(f"_e.{DELTA}").alias(DELTA))


def with_concurrency(runs: DataFrame, tenant: str = "tenant_id", begin: str = "run_time", seconds: str = "ingestion_time_sec") -> DataFrame:
    """Adds ``files_at_once`` and ``tenants_at_once``: the runs under way when a run starts, itself among them, and their tenants.

    A run is under way from its start until just before its end, for a microsecond at least. Runs without a start or a
    duration are left out; a null tenant is a tenant. Changes at one time are added up before they are put in order, and
    running sums span range partitions, so that neither a busy moment nor a busy tenant meets in one task.
    """
    start = F.unix_micros(F.col(begin).cast("timestamp"))
    length = F.greatest(F.lit(1).cast("bigint"), F.round(F.col(seconds) * 1_000_000).cast("bigint"))
    known = runs.filter(F.col(begin).isNotNull() & F.col(seconds).isNotNull()).withColumn(BEGIN, start).withColumn(END, F.col(BEGIN) + length)
    files = running_sum(_steps(known, []), [], [AT], DELTA, "files_at_once")
    busy = running_sum(_steps(known, [tenant]), [tenant], [AT], DELTA, LEVEL)
    # A tenant is busy from where its level leaves zero to where it is back.
    turn = (F.col(LEVEL) > 0).cast("bigint") - (F.col(LEVEL) - F.col(DELTA) > 0).cast("bigint")
    tenants = running_sum(busy.groupBy(AT).agg(F.sum(turn).alias(DELTA)), [], [AT], DELTA, "tenants_at_once")
    levels = join_small(files.select(AT, "files_at_once"), tenants.select(AT, "tenants_at_once"), [AT])
    return join_small(known.withColumn(AT, F.col(BEGIN)), levels, [AT]).drop(AT, BEGIN, END)


def throughput_by_concurrency(runs: DataFrame, tenant: str = "tenant_id", begin: str = "run_time", seconds: str = "ingestion_time_sec", places: int = 6) -> DataFrame:
    """Runs and their mean throughput by how many files and tenants were under way at their start."""
    placed = with_concurrency(runs, tenant, begin, seconds)
    mean = F.round(F.avg("throughput_mb_sec"), places).alias("mean_throughput")
    return placed.groupBy("files_at_once", "tenants_at_once").agg(F.count("*").alias("runs"), mean)
