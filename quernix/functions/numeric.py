"""Column builders on numbers: losses, schedules, bands and quantiles of the different definitions in use."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TIE_EPS = 1e-6
REF_NOISE_NATS = 1e-3
TIERS = (("sweet", 0.10, 0.90), ("hard", 0.00, 0.10), ("easy", 0.90, 1.01))


def neg_log_sigmoid(x: Column) -> Column:
    """-log(sigmoid(x)) without overflow."""
    return F.greatest(-x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def preference_loss(chosen: Column, rejected: Column, ref_chosen: Column, ref_rejected: Column, beta: float, variant: str = "sigmoid", smoothing: float = 0.0) -> Column:
    """(loss, reward_chosen, reward_rejected, margin) of a pair of log probabilities, in double precision."""
    c, r, rc, rr = (x.cast("double") for x in (chosen, rejected, ref_chosen, ref_rejected))
    z = (c - r) - (rc - rr)
    if variant == "ipo":
        loss = F.pow(z - 1.0 / (2.0 * beta), F.lit(2.0))
    elif variant == "sigmoid":
        loss = neg_log_sigmoid(beta * z) * (1.0 - smoothing) + neg_log_sigmoid(-beta * z) * smoothing
    else:
        raise ValueError(f"unknown variant {variant!r}")
    return F.struct(loss.alias("loss"), (beta * (c - rc)).alias("reward_chosen"), (beta * (r - rr)).alias("reward_rejected"), (beta * z).alias("margin"))


def rank_score(margin: Column) -> Column:
    """1, 0.5 or 0: won, tied within a band, lost."""
    return F.when(margin > TIE_EPS, 1.0).when(margin < -TIE_EPS, 0.0).otherwise(0.5)


def below_noise_floor(margin: Column, beta: float) -> Column:
    return F.abs(margin) < beta * REF_NOISE_NATS


def cosine_schedule(step: Column, total: int, warmup: int, peak: float, floor: float = 0.0) -> Column:
    """Linear warm-up from 0, then a half cosine down to floor."""
    up = peak * (step + 1) / F.lit(float(max(1, warmup)))
    t = (step - warmup) / F.lit(float(max(1, total - warmup)))
    return F.when(step < warmup, up).otherwise(floor + (peak - floor) * 0.5 * (1.0 + F.cos(F.lit(math.pi) * F.least(t, F.lit(1.0)))))


def tier_of(trials: Column, rate: Column, least: int) -> Column:
    out = F.when(trials < least, "unknown")
    for name, lo, hi in TIERS:
        out = out.when((rate >= lo) & (rate < hi), name)
    return out.otherwise("unknown")


def nearest_rank_place(n: Column, q: float) -> Column:
    """0-based place min(n - 1, int(q * n)) among n sorted values."""
    return F.least(n - 1, F.floor(q * n))


def exclusive_places(n: Column, parts: int, cut: int) -> Column:
    """0-based place of the value below the cut-th of the cut points into parts of equal probability, ends excluded; the
    last place while there are no more values than parts."""
    j = F.greatest(F.lit(1), F.least(n - 1, F.floor(F.lit(cut) * (n + 1) / parts)))
    return F.when(n > parts, j - 1).otherwise(n - 1)


def exclusive_quantile(n: Column, low: Column, high: Column, parts: int, cut: int) -> Column:
    """The cut point between low, the value at exclusive_places, and high, the one after it."""
    j = exclusive_places(n, parts, cut) + 1
    delta = F.lit(cut) * (n + 1) - j * parts
    return F.when(n > parts, (low.cast("double") * (parts - delta) + high.cast("double") * delta) / parts).otherwise(low.cast("double"))


def ratio(a: Column, b: Column) -> Column:
    """Sum over sum with 1 as the least divisor."""
    return F.sum(a) / F.greatest(F.lit(1), F.sum(b))


def gib(n_bytes: Column) -> Column:
    return n_bytes / F.lit(float(2**30))


def sandbox_slots(cores: Column, ram_gib: Column) -> Column:
    return F.least(F.floor(cores / 4), F.floor(ram_gib / 8)).cast("bigint")


def expected_steps(rows: Column, batch: int, epochs: int) -> Column:
    """(steps, tolerance) of a run over rows."""
    steps = F.floor(rows / batch) * max(1, epochs)
    return F.struct(steps.cast("bigint").alias("steps"), F.greatest(F.lit(3.0), 0.15 * steps).alias("tolerance"))


def band_verdict(base: Column, candidate: Column, base_std: Column, candidate_std: Column, least: float = 2.0) -> Column:
    """better, worse or within the noise band of the two spreads."""
    band = F.greatest(F.lit(least), base_std + candidate_std)
    d = candidate - base
    return F.when(d > band, "better").when(d < -band, "worse").otherwise("within")
