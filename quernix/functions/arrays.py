"""Column builders on token arrays and masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def piece_lengths(text: Column) -> Column:
    """A stand-in tokenizer for plans without a vocabulary: lengths of the pieces between blanks."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), " "), lambda w: F.length(w))


def message_ids(messages: Column) -> Column:
    return F.flatten(F.transform(messages, lambda m: piece_lengths(m["content"])))


def message_mask(messages: Column) -> Column:
    """1 for tokens of assistant turns, aligned with message_ids."""
    return F.flatten(F.transform(messages, lambda m: F.transform(piece_lengths(m["content"]), lambda w: (m["role"] == "assistant").cast("int"))))


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("bigint"), lambda x, y: x + y)


def common_prefix_len(a: Column, b: Column) -> Column:
    """Length of the longest common prefix."""
    p = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(p == 0, F.size(a).cast("bigint")).otherwise(p - 1)


def first_supervised(mask: Column) -> Column:
    """0-based place of the first trained token; the length if there is none."""
    p = F.array_position(mask, 1)
    return F.when(p == 0, F.size(mask).cast("bigint")).otherwise(p - 1)


def prompt_divergence(mask: Column, shared: Column) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), first_supervised(mask) - shared)


def mask_reason(ids: Column, mask: Column) -> Column:
    """First thing wrong with a token row, null if sound."""
    return (
        F.when(F.size(ids) != F.size(mask), "misaligned").when(F.size(ids) == 0, "empty").when(total(mask) == 0, "no_trained_tokens").when(mask[0] == 1, "leading_trained_token")
    )


def padded_row(ids: Column, mask: Column, length: int, pad_id: int, truncation: str = "error", pad: bool = True) -> Column:
    """Fields of a training row of fixed length; truncation left, right or error."""
    n = F.size(ids)
    fits = F.least(n, F.lit(length))
    cut = {"right": lambda a: F.slice(a, 1, length), "left": lambda a: F.slice(a, F.greatest(n - length + 1, F.lit(1)), length)}.get(truncation, lambda a: F.when(n > length, F.raise_error(F.concat(n.cast("string"), F.lit(f" tokens exceed {length}")))).otherwise(a))
    room = F.lit(length) - fits
    fill = lambda a, v: F.concat(a, F.array_repeat(F.lit(v), room)) if pad else a
    positions = F.when(fits > 0, F.sequence(F.lit(0), fits - 1)).otherwise(F.array().cast("array<int>"))
    ones = F.array_repeat(F.lit(1), fits)
    fields = [fill(cut(ids), pad_id).alias("input_ids"), fill(positions, 0).alias("position_ids"), fill(cut(mask), 0).alias("loss_mask")]
    return F.struct(*fields, *([fill(ones, 0).alias("attention_mask")] if pad else []))


def labels(ids: Column, mask: Column, ignore: int = -100) -> Column:
    return F.zip_with(ids, mask, lambda i, m: F.when(m == 1, i).otherwise(F.lit(ignore)))


def supervised_positions(mask: Column) -> Column:
    """0-based places of trained tokens, the first place never among them."""
    return F.filter(F.transform(mask, lambda m, i: F.when((m == 1) & (i > 0), i)), lambda x: x.isNotNull())


def trained_text(pieces: Column, mask: Column) -> Column:
    both = F.arrays_zip(pieces.alias("p"), mask.alias("m"))
    return F.array_join(F.transform(F.filter(both, lambda x: x["m"] == 1), lambda x: x["p"]), " ")


def relative_l2(a: Column, b: Column) -> Column:
    """Length of a - b against that of b, or against 1 for a zero b."""
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    diff = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    base = norm(F.transform(b, lambda x: x.cast("double")))
    return norm(diff) / F.when(base == 0, F.lit(1.0)).otherwise(base)


def spread_indices(n: Column, k: int) -> Column:
    """k places of 0..n-1 spread evenly, halves rounded to even; all places if n <= k."""
    if k <= 0:
        return F.array().cast("array<int>")
    some = F.when(n <= 0, F.array().cast("array<int>")).when(n <= k, F.sequence(F.lit(0), n - 1))
    step = (n - 1) / F.lit(float(k - 1)) if k > 1 else F.lit(0.0)
    return some.otherwise(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.rint(i * step).cast("int")))
