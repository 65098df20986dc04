"""Queries on schedules, sizes of models and reports, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import training as T
from .sql import read

STEPS, WARMUP, WARMDOWN, LAST, DECAY, RATIO = 2000, 100, 0.5, 0.05, 0.2, 10.5
DEVICES = ("NVIDIA H100 NVL", "NVIDIA H100 80GB HBM3", "NVIDIA A100-SXM4", "NVIDIA H200", "NVIDIA H100 PCIe", "unheard of")


def _schedule(spark: SparkSession, d: str) -> DataFrame:
    """Every order as a step of a run."""
    rows = read(spark, d, "orders").select("o_orderkey", F.pmod("o_orderkey", F.lit(STEPS + 1)).alias("step"))
    done = F.col("step") / float(STEPS)
    return rows.select(
        "o_orderkey", F.round(T.lr_by_step(F.col("step"), STEPS, WARMUP, WARMDOWN, LAST), 9).alias("by_step"),
        F.round(T.lr_by_progress(done, 0.1, WARMDOWN, 0.0), 9).alias("by_progress"),
    )


def _momentum(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "orders").select("o_orderkey", F.pmod("o_orderkey", F.lit(STEPS + 1)).alias("step"))
    return rows.select(
        "o_orderkey", F.round(T.momentum(F.col("step"), STEPS, WARMDOWN), 9).alias("momentum"),
        F.round(T.weight_decay(F.col("step"), STEPS, DECAY), 9).alias("decay"),
    )


def _shape(depth) -> T.Shape:
    """The shape of a model of a depth: 64 to a layer, in heads of 128, two of which share keys where they are even."""
    width = F.ceil(depth * 64 / 128) * 128
    heads = F.floor(width / 128)
    kv = F.when(heads % 2 == 0, F.floor(heads / 2)).otherwise(heads)
    return T.Shape(depth, width, heads, kv, F.lit(32_741), F.lit(2048))


def _windows(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "part").select("p_partkey", F.posexplode(_shape(F.col("p_size")).windows()).alias("layer", "attended"))
    return rows


def _parameters(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part").select("p_partkey", _shape(F.col("p_size")).parameters().alias("p")).select("p_partkey", "p.*")


def _flops(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part").select("p_partkey", _shape(F.col("p_size")).flops_per_token().cast("bigint").alias("flops"))


def _plan(spark: SparkSession, d: str) -> DataFrame:
    """Runs of ``RATIO`` tokens a weight, against one of depth 12."""
    tokens = F.floor(RATIO * _shape(F.col("p_size")).scaling_parameters())
    plan = T.run_plan(tokens, RATIO * _shape(F.lit(12)).scaling_parameters(), DECAY)
    rows = read(spark, d, "part").select("p_partkey", tokens.alias("tokens"), plan.alias("r"))
    return rows.select("p_partkey", "tokens", "r.batch", "r.steps", F.round("r.lr_scale", 9).alias("lr_scale"), F.round("r.decay", 9).alias("decay"))


def _speed(spark: SparkSession, d: str) -> DataFrame:
    """Steps that take as long as an event's value tells, on devices by turns; no peak is known of the last."""
    device = F.get(F.array(*[F.lit(x) for x in DEVICES]), F.pmod("event_id", F.lit(len(DEVICES))).cast("int"))
    seconds, batch = F.abs("value") / 100 + 0.25, F.lit(T.REFERENCE_BATCH)
    peak, flops = T.first_rule(device, T.PEAKS), _shape(F.lit(12)).flops_per_token()
    return read(spark, d, "events").select(
        "event_id", peak.alias("peak"), T.tokens_per_second(batch, seconds).alias("tokens_per_second"),
        F.round(T.utilization(flops, batch, seconds, peak, 8), 6).alias("mfu"),
    )


def _values(spark: SparkSession, d: str) -> DataFrame:
    price = F.col("p_retailprice")
    return read(spark, d, "part").select("p_partkey", T.shown_float(price / 7).alias("as_float"), T.shown_int((price * F.col("p_size")).cast("bigint")).alias("as_int"))


def _clock(spark: SparkSession, d: str) -> DataFrame:
    """From the first to the last row of each series; a series of one row has no end."""
    rows = read(spark, d, "documents").filter("origin_id is not null").groupBy("source", "origin_id").agg(
        F.min("collected_at").alias("a"), F.when(F.count("*") > 1, F.max("collected_at")).alias("b")
    )
    return rows.select("source", "origin_id", T.wall_clock(F.col("a"), F.col("b")).alias("took"))


_S = f"(SELECT o_orderkey, o_orderkey % {STEPS + 1} AS s FROM orders)"
_SHAPES = """WITH w AS (SELECT p_partkey, p_size AS n, ((p_size * 64 + 127) // 128) * 128 AS d FROM part),
h AS (SELECT *, d // 128 AS h, CASE WHEN (d // 128) % 2 = 0 THEN d // 256 ELSE d // 128 END AS kv, 32768 AS v FROM w),
l AS (SELECT *, unnest(generate_series(0, n - 1)) AS i FROM h),
a AS (SELECT *, CASE WHEN i = n - 1 OR i % 4 = 3 THEN 2048 ELSE 512 END AS far, (n - 1 - i) % 2 = 0 AS own FROM l)"""
_SUMS = f"""{_SHAPES}, p AS (SELECT p_partkey, any_value(n) AS n, any_value(d) AS d, any_value(h) AS h, any_value(v * d)::BIGINT AS wte, sum(CASE WHEN own THEN v * kv * 128 ELSE 0 END)::BIGINT AS value_embeds,
  any_value(v * d)::BIGINT AS lm_head, sum(d * d + d * kv * 128 + d * kv * 128 + d * d + 4 * d * d + 4 * d * d + CASE WHEN own THEN 12 * kv ELSE 0 END)::BIGINT AS matrices,
  (sum(2) + 24 + 1 + 1)::BIGINT AS scalars, sum(far)::BIGINT AS far FROM a GROUP BY p_partkey)"""
#: Weights of the reference run's matrices and head: depth 12, width 768, 6 heads, 3 for keys, 6 layers with own values.
_D12 = "(12 * (768 * 768 * 2 + 768 * 384 * 2 + 768 * 768 * 8) + 6 * 12 * 3 + 32768 * 768)"
_F12 = f"(6 * {_D12} + 12 * 768 * (9 * 512 + 3 * 2048))"
_RULES = ", ".join(f"({i}, '{p[0]}', '{p[-1]}', {v})" for i, (p, v) in enumerate(T.PEAKS))
_DEV = "[" + ", ".join(f"'{x}'" for x in DEVICES) + "]"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "lr_schedule": _schedule, "momentum_schedule": _momentum, "layer_windows": _windows, "parameter_counts": _parameters,
    "flops_per_token": _flops, "scaling_plan": _plan, "step_speed": _speed, "value_format": _values, "wall_clock": _clock,
}

ORACLES: dict[str, str] = {
    "lr_schedule": f"""SELECT o_orderkey, round(least(least((s + 1) / 100.0, 1.0), CASE WHEN s > 1000 THEN 0.05 + 0.95 * (2000 - s) / 1000.0 ELSE 1.0 END), 9)::DOUBLE AS by_step,
        round(CASE WHEN s < 200 THEN (s / 2000.0 + 1e-8) * 10 WHEN s <= 1000 THEN 1.0 ELSE (2000 - s) / 1000.0 END, 9)::DOUBLE AS by_progress FROM {_S}""",
    "momentum_schedule": f"""SELECT o_orderkey, round(CASE WHEN s < 400 THEN 0.85 * (400 - s) / 400.0 + 0.97 * s / 400.0 WHEN s < 1000 THEN 0.97 ELSE 0.97 * (2000 - s) / 1000.0 + 0.90 * (s - 1000) / 1000.0 END, 9)::DOUBLE AS momentum,
        round(0.1 + 0.1 * cos(pi() * s / 2000.0), 9) AS decay FROM {_S}""",
    "layer_windows": f"{_SHAPES} SELECT p_partkey, i::INT AS layer, far::BIGINT AS attended FROM a",
    "parameter_counts": f"{_SUMS} SELECT p_partkey, wte, value_embeds, lm_head, matrices, scalars, wte + value_embeds + lm_head + matrices + scalars AS total FROM p",
    "flops_per_token": f"{_SUMS} SELECT p_partkey, (6 * (lm_head + matrices) + 12 * d * far)::BIGINT AS flops FROM p",
    "scaling_plan": f"""{_SUMS}, t AS (SELECT p_partkey, floor((lm_head + matrices) * {RATIO}::DOUBLE)::BIGINT AS tokens FROM p),
        b AS (SELECT *, pow(2, round_even(19 + 0.383 * log2(tokens / ({_D12} * {RATIO}::DOUBLE)), 0)) AS batch FROM t)
        SELECT p_partkey, tokens, batch::BIGINT AS batch, floor(tokens / batch)::BIGINT AS steps, round(sqrt(batch / 524288), 9) AS lr_scale, round({DECAY}::DOUBLE * sqrt(batch / 524288) * {_D12} * {RATIO}::DOUBLE / tokens, 9) AS decay FROM b""",
    "step_speed": f"""WITH e AS (SELECT event_id, lower(({_DEV})[1 + event_id % {len(DEVICES)}]) AS device, abs(value) / 100 + 0.25 AS s FROM events),
        r AS (SELECT event_id, any_value(s) AS s, arg_min(peak, i) AS peak FROM e LEFT JOIN (VALUES {_RULES}) x(i, p, q, peak) ON contains(device, p) AND contains(device, q) GROUP BY event_id)
        SELECT event_id, peak::DOUBLE AS peak, floor(524288 / s)::BIGINT AS tokens_per_second, round(100.0 * {_F12} * 524288 / s / (peak::DOUBLE * 8), 6) AS mfu FROM r""",
    "value_format": "SELECT p_partkey, format('{:.4f}', p_retailprice / 7) AS as_float, CASE WHEN v >= 10000 THEN format('{:,}', v) ELSE v::VARCHAR END AS as_int FROM (SELECT *, trunc(p_retailprice * p_size)::BIGINT AS v FROM part)",
    "wall_clock": """WITH t AS (SELECT source, origin_id, CASE WHEN count(*) > 1 THEN epoch_us(max(collected_at)) - epoch_us(min(collected_at)) END // 60000000 AS m FROM documents WHERE origin_id IS NOT NULL GROUP BY ALL)
        SELECT source, origin_id, coalesce((m // 60) || 'h' || (m % 60) || 'm', 'unknown') AS took FROM t""",
}
