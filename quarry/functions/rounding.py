"""Rounding a double by its exact binary value, ties to even, as Python's ``round`` does.

``2.675`` is stored as 2.67499999999999982…, so it rounds to 2.67; ``0.125`` is stored exactly and its tie goes to
the even 0.12. ``money.round_half_up`` reads the printed decimal instead (2.68 and 0.13).

Scaled to whole steps a double is off by less than its last bit, so unless it comes that close to a half, the step is known and one
division of whole numbers gives the result. Near a half the exact value decides: the part after the point is a whole number of
2^-90 (below that it is too small to matter for ten digits); two 64-bit steps take it out without rounding, decimals of
whole numbers do the rest. All of it is SQL text, no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.limbs import let, quoted

MOST_DIGITS = 10


def round_half_even(name: str, digits: int = 2) -> Column:
    """A column of doubles rounded to ``digits`` places (0 to 10); NaN, infinities and null stay. The result is the nearest double."""
    if not 0 <= digits <= MOST_DIGITS:
        raise ValueError(f"digits must be between 0 and {MOST_DIGITS}")
    v = f"CAST({quoted(name)} AS DOUBLE)"
    unit, scale = f"CAST('{1 << 90}' AS DECIMAL(28,0))", f"CAST('{10**digits}' AS DECIMAL(11,0))"
    # t.whole: before the point; t.a and t.b: after it, in units of 2^-30 and the rest of that in 2^-90
    parts = let(
        "p", f"named_struct('whole', floor(abs({v})), 'rest', abs({v}) - floor(abs({v})))",
        "named_struct('whole', CAST(p.whole AS DECIMAL(20,0)), 'a', CAST(floor(p.rest * 1073741824D) AS DECIMAL(20,0)), "
        "'b', CAST(floor((p.rest * 1073741824D - floor(p.rest * 1073741824D)) * 1152921504606846976D) AS DECIMAL(20,0)))",
    )
    steps = f"CAST((t.a * CAST('{1 << 60}' AS DECIMAL(19,0)) + t.b) * {scale} AS DECIMAL(38,0))"
    over = f"named_struct('whole', t.whole, 'over', CAST({steps} % {unit} AS DECIMAL(28,0)), 'up', CAST(({steps} - {steps} % {unit}) / {unit} AS DECIMAL(11,0)))"
    half = f"CAST('{1 << 89}' AS DECIMAL(27,0))"
    odd = "(u.up % 2BD = 1BD)" if digits else "((u.whole + u.up) % 2BD = 1BD)"
    up = f"(u.up + IF(u.over > {half} OR (u.over = {half} AND {odd}), 1BD, 0BD))"
    text = f"concat(CAST(CAST(w.whole + IF(w.up >= {scale}, 1BD, 0BD) AS DECIMAL(21,0)) AS STRING), '.', lpad(CAST(CAST(w.up % {scale} AS DECIMAL(11,0)) AS STRING), {max(digits, 1)}, '0'))"
    shown = let("t", parts, let("u", over, let("w", f"named_struct('whole', u.whole, 'up', {up})", f"CAST({text} AS DOUBLE)")))
    small = f"abs({v}) < 4503599627370496D"  # from 2^52 on doubles are whole numbers
    x = f"(abs({v}) * 1E{digits}D)"
    clear = f"{x} < 1E15D AND abs({x} - floor({x}) - 0.5D) > {x} * 1E-15D"
    plain = f"CAST(floor({x}) + IF({x} - floor({x}) > 0.5D, 1L, 0L) AS DOUBLE) / 1E{digits}D"
    return F.expr(f"CASE WHEN {clear} THEN IF({v} < 0D, -1D, 1D) * {plain} WHEN {small} THEN IF({v} < 0D, -1D, 1D) * {shown} ELSE {v} END")
