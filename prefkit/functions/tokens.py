"""Token-id arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def truncate(ids: Column, limit: int | None) -> Column:
    """The first ``limit`` ids; everything when there is no limit."""
    return ids if limit is None else F.slice(ids, 1, limit)


def attention_mask(ids: Column) -> Column:
    return F.array_repeat(F.lit(1), F.size(ids))


def join_ids(prompt: Column, response: Column) -> Column:
    return F.concat(prompt, response)


def strip_prompt(generated: Column, prompt: Column) -> Column:
    """What follows the prompt; empty when nothing was generated."""
    return F.slice(generated, F.size(prompt) + 1, F.greatest(F.size(generated) - F.size(prompt), F.lit(0)))


def drop_ids(ids: Column, special: Sequence[int]) -> Column:
    """Ids without the special ones."""
    return F.filter(ids, lambda i: ~i.isin(list(special)))


def pad_right(ids: Column, width: Column, pad_id: int) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(pad_id), width - F.size(ids)))


def pad_left(ids: Column, width: Column, pad_id: int) -> Column:
    return F.concat(F.array_repeat(F.lit(pad_id), width - F.size(ids)), ids)


def pad_mask(ids: Column, width: Column, left: bool = False) -> Column:
    ones, zeros = attention_mask(ids), F.array_repeat(F.lit(0), width - F.size(ids))
    return F.concat(zeros, ones) if left else F.concat(ones, zeros)


def padding_id(pad_id: int | None, eos_id: int | None) -> int | None:
    """The pad id, or the end-of-sequence id where no pad id exists."""
    return eos_id if pad_id is None else pad_id
