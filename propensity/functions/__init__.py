"""Column expressions: no joins, no shuffles, legal on streaming frames."""

from propensity.functions.columns import (  # noqa: F401
    cross,
    finite,
    flag,
    flag_product,
    floor_mod,
    integral,
    num_product,
    ordinal,
    ordinal_product,
    ratio,
    row_diff,
    row_sum,
    strip,
    target_lenient,
    target_strict,
)
