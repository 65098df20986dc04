"""Arithmetic of training runs over columns: schedules, sizes of models, and how reports show values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Multiples that vocabularies and attended lengths are rounded up to (fixed values).
VOCABULARY_PAD, WINDOW_TILE = 64, 128
#: Channels of the gates in a layer, and weights besides the layers' own (fixed values).
GATE_CHANNELS, SMEAR_WEIGHTS, SINGLE_WEIGHTS = 12, 24, 2
#: Batch that the smallest loss was found with at the reference depth, and how it grows with the tokens (fixed values).
REFERENCE_BATCH, BATCH_POWER = 1 << 19, 0.383
#: Names of devices -> peak floating point operations a second; the first row all of whose parts a name holds counts
#: (fixed values, in this order).
PEAKS = (
    (("gb200",), 2.5e15), (("b200",), 2.25e15), (("h200", "nvl"), 836e12), (("h200",), 989e12), (("h100", "nvl"), 835e12),
    (("h100", "pcie"), 756e12), (("h100",), 989e12), (("a100",), 312e12),
)


def lr_by_step(step: Column, steps: int, warmup: int, warmdown: float, last: float) -> Column:
    """Share of the learning rate at a step: up over ``warmup`` steps, down to ``last`` over the part ``warmdown``."""
    down = round(warmdown * steps)
    left = (F.lit(float(steps)) - step) / max(1, down)
    return F.when(step < warmup, (step + 1) / F.lit(float(max(1, warmup)))).when(step <= steps - down, 1.0).otherwise(left + (1 - left) * last)


def lr_by_progress(progress: Column, warmup: float, warmdown: float, last: float) -> Column:
    """As ``lr_by_step`` over the part of the run that is done."""
    down = (progress - (1 - warmdown)) / (warmdown or 1.0)
    return F.when(progress < warmup, (progress + 1e-8) / (warmup or 1.0)).when(progress <= 1 - warmdown, 1.0).otherwise((1 - down) + down * last)


def momentum(step: Column, steps: int, warmdown: float) -> Column:
    """Up from 0.85 to 0.97 over 400 steps, down to 0.90 over the part ``warmdown``."""
    down = round(warmdown * steps)
    rising, falling = step / F.lit(400.0), (step - (steps - down)) / F.lit(float(max(1, down)))
    return F.when(step < 400, 0.85 + rising * 0.12).when(step >= steps - down, 0.97 - 0.07 * falling).otherwise(0.97)


def weight_decay(step: Column, steps: int, whole: float) -> Column:
    """Half a cosine from ``whole`` to nothing."""
    return whole * 0.5 * (1 + F.cos(F.pi() * step / float(steps)))


def _up(value: Column, to: int) -> Column:
    return F.ceil(value / to) * to


@dataclass(frozen=True)
class Shape:
    """A model's shape, as columns."""

    layers: Column
    width: Column
    heads: Column
    kv_heads: Column
    vocabulary: Column
    length: Column
    pattern: str = "SSSL"

    def windows(self) -> Column:
        """How far each layer attends: a quarter of the length where the pattern has S, all of it where L and last."""
        short = _up(F.ceil(self.length / 4), WINDOW_TILE).cast("bigint")
        letters = F.array(*[F.lit(c) for c in self.pattern])
        far = lambda i: (F.get(letters, i % len(self.pattern)) == "L") | (i == self.layers - 1)
        layers = F.sequence(F.lit(0), self.layers.cast("int") - 1)
        return F.transform(layers, lambda i: F.when(far(i), self.length.cast("bigint")).otherwise(short))

    def parameters(self) -> Column:
        """struct(wte, value_embeds, lm_head, matrices, scalars, total); every other layer, and the last, has values of
        its own for each token."""
        n, d = self.layers.cast("bigint"), self.width.cast("bigint")
        kv = self.kv_heads.cast("bigint") * F.floor(d / self.heads)
        table = _up(self.vocabulary, VOCABULARY_PAD).cast("bigint")
        valued = F.floor((n + 1) / 2)
        matrices = n * (2 * d * d + 2 * d * kv + 8 * d * d) + valued * GATE_CHANNELS * self.kv_heads.cast("bigint")
        parts = {
            "wte": table * d, "value_embeds": valued * table * kv, "lm_head": table * d, "matrices": matrices,
            "scalars": 2 * n + SMEAR_WEIGHTS + SINGLE_WEIGHTS,
        }
        total = sum(parts.values(), F.lit(0).cast("bigint"))
        return F.struct(*[c.cast("bigint").alias(k) for k, c in parts.items()], total.cast("bigint").alias("total"))

    def scaling_parameters(self) -> Column:
        return self.parameters()["matrices"] + self.parameters()["lm_head"]

    def flops_per_token(self) -> Column:
        """6 for each weight that is multiplied, 12 for each place attended to and value of the heads."""
        attended = F.aggregate(self.windows(), F.lit(0).cast("bigint"), lambda a, w: a + F.least(w, self.length.cast("bigint")))
        return 6 * self.scaling_parameters() + 12 * self.heads.cast("bigint") * F.floor(self.width / self.heads) * attended


def run_plan(tokens: Column, reference_tokens: Column, decay: float) -> Column:
    """struct(batch, steps, lr_scale, decay) of a run over ``tokens``: the batch is the nearest power of 2, exact halves
    to the even exponent."""
    exponent = F.bround(F.log2(REFERENCE_BATCH * F.pow(tokens / reference_tokens, F.lit(BATCH_POWER))), 0)
    batch = F.pow(F.lit(2.0), exponent)
    scale = F.sqrt(batch / REFERENCE_BATCH)
    return F.struct(
        batch.cast("bigint").alias("batch"), F.floor(tokens / batch).cast("bigint").alias("steps"), scale.alias("lr_scale"),
        (decay * scale * (reference_tokens / tokens)).alias("decay"),
    )


def first_rule(name: Column, rules: tuple) -> Column:
    """The value of the first rule all of whose parts the name holds, whatever its case; null where none does."""
    low, out = F.lower(name), None
    for parts, value in rules:
        holds = low.contains(parts[0])
        for part in parts[1:]:
            holds = holds & low.contains(part)
        out = F.when(holds, F.lit(value)) if out is None else out.when(holds, F.lit(value))
    return out


def tokens_per_second(batch: Column, seconds: Column) -> Column:
    return F.floor(batch / seconds).cast("bigint")


def utilization(flops_per_token: Column, batch: Column, seconds: Column, peak: Column, devices: int) -> Column:
    """Percent of the devices' peak that a step's operations are."""
    return 100 * flops_per_token * batch / seconds / (peak * devices)


def shown_float(value: Column) -> Column:
    return F.format_string("%.4f", value.cast("double"))


def shown_int(value: Column) -> Column:
    """With commas from 10,000 on."""
    return F.when(value >= 10_000, F.format_number(value, 0)).otherwise(value.cast("string"))


def wall_clock(start: Column, end: Column) -> Column:
    """Whole hours and minutes between two times, ``unknown`` where one is missing."""
    seconds = F.floor((F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1_000_000)
    hours, minutes = F.floor(seconds / 3600), F.floor((seconds % 3600) / 60)
    return F.coalesce(F.concat(hours.cast("string"), F.lit("h"), minutes.cast("string"), F.lit("m")), F.lit("unknown"))
