"""Mean-scale uniform-bin quantisation of scaled values into token ids.

Fixed values of the tokenizer configuration (they must match for the token
ids to mean the same thing):
  n_tokens = 4096, special tokens: PAD = 0, EOS = 1 (two special ids),
  bin centres: n_tokens - 2 - 1 = 4093 equally spaced on [low, high] = [-15.0, 15.0],
  first regular id = 3, label ignore index = -100.
A value lands in the bin whose centre is nearest (ties go up), i.e.
``id = clamp(floor((x - low) / width + 0.5), 0, n_bins - 1) + 3`` with
``width = (high - low) / (n_bins - 1)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAD_ID = 0
EOS_ID = 1
N_TOKENS = 4096
LOW, HIGH = -15.0, 15.0
N_BINS = N_TOKENS - 2 - 1
FIRST_ID = 3
IGNORE = -100
WIDTH = (HIGH - LOW) / (N_BINS - 1)


def token_id(scaled: Column) -> Column:
    """Token id of a scaled value: nearest bin centre (ties go up), clamped to the regular ids."""
    raw = F.floor((scaled - F.lit(LOW)) / F.lit(WIDTH) + F.lit(0.5))
    return (F.least(F.greatest(raw, F.lit(0)), F.lit(N_BINS - 1)) + F.lit(FIRST_ID)).cast("int")


def token_centre(tok: Column) -> Column:
    """Bin centre of a regular token id; NULL for special ids."""
    return F.when(tok >= F.lit(FIRST_ID),
                  F.lit(LOW) + (tok - F.lit(FIRST_ID)).cast("double") * F.lit(WIDTH))


def sql_token_id(scaled: str) -> str:
    raw = f"floor(({scaled} - ({LOW})) / {WIDTH!r} + 0.5)"
    return f"CAST(least(greatest({raw}, 0), {N_BINS - 1}) + {FIRST_ID} AS INTEGER)"


def sql_token_centre(tok: str) -> str:
    return f"CASE WHEN {tok} >= {FIRST_ID} THEN ({LOW}) + ({tok} - {FIRST_ID}) * {WIDTH!r} END"
