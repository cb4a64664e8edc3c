"""Exact sums of numbers of very different size: a limb accumulator of SQL expressions.

A sum is kept as a few whole-number columns (its state), which add up without rounding in any order and are joined
once, after the aggregate:

=====  =====================================================  ============
field  holds the sum of                                       in units of
=====  =====================================================  ============
lo     the lower 20 bits of values in whole cents             cents
hi     the other bits of those                                2^20 cents
a      what other values have beyond 18 places                10^-36
b      what they have after the point, to 18 places           10^-18
c      their whole part                                       1
odd    NaN and infinities                                     (a double)
=====  =====================================================  ============

Money mostly is whole cents, so ``lo`` and ``hi``, two 64-bit sums, do the work and the other fields stay null; only
a value that is not takes the way through decimals. A float counts as the decimal number it prints as (``0.1`` is a
tenth), decimals and integers as they are. Values of under 10^38 with no digit beyond 36 places fit; others raise, and so
does a sum of 10^38 or more. The other fields have room for 10^12 values of a group at least.

All of it is SQL text over a column name, parsed in one call. ``let`` binds a value that is used more than once. A state is a
struct, so it can be stored, joined, and merged (``merge``) on the next level.
"""

from __future__ import annotations

FIELDS = ("lo", "hi", "a", "b", "c", "odd")
E18, E36 = 10**18, 10**36


def quoted(name: str) -> str:
    """A column name as SQL."""
    return f"`{name.replace('`', '``')}`"


def let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _dec(n: int) -> str:
    return f"CAST('{n}' AS DECIMAL({len(str(n))},0))"


def add(v: str) -> dict[str, str]:
    """The aggregates of a column's state; ``v`` is SQL of the value."""
    floats, decimals = f"typeof({v}) IN ('double', 'float')", f"typeof({v}) LIKE 'decimal%'"  # known, so folded, when planned
    real, text = f"CAST({v} AS DOUBLE)", f"CAST({v} AS STRING)"
    size, cents = f"abs({real})", f"rint({real} * 100D)"
    whole = f"({size} < 87960930222.08D AND IF({decimals}, CAST({cents} AS DECIMAL(20,0)) * 0.01BD = {v}, {cents} / 100D = {v}))"
    odd = f"({floats} AND (isnan({real}) OR {size} = double('infinity')))"
    raised = f"raise_error(concat('an exact sum takes no digit below 1E-36 and nothing from 1E38 on: ', {text}))"
    tiny, mid = f"CAST({text} AS DECIMAL(37,36))", f"CAST({text} AS DECIMAL(36,18))"
    tail, units = f"CAST({v} % 1BD AS DECIMAL(37,36))", f"CAST({mid} AS DECIMAL(19,0))"
    near = "CAST({} AS DECIMAL(19,18))".format
    # large numbers are not printed in the fewest digits by every JVM: 15 to 17 are taken, the fewest that read as the same number
    doubles = f"typeof({v}) = 'double'"
    printed = [f"format_string('%.{k}e', {real})" for k in (14, 15, 16)]
    fewest = f"coalesce({', '.join(f'IF(CAST({x} AS DOUBLE) = {real} AND {doubles}, {x}, NULL)' for x in printed)}, {text})"

    def other(on_floats: str, on_decimals: str, on_integers: str = "NULL") -> str:
        by_type = f"CASE WHEN {floats} THEN {on_floats} WHEN {decimals} THEN {on_decimals} ELSE {on_integers} END"
        return f"sum(CASE WHEN {v} IS NULL OR {whole} OR {odd} THEN NULL ELSE {by_type} END)"

    def fine(x: str) -> str:
        return f"CAST(({x} - {near(x)}) * {_dec(E36)} AS DECIMAL(26,0))"

    def places(x: str) -> str:
        return f"CAST({x} * {_dec(E18)} AS DECIMAL(26,0))"

    bits = f"CAST({cents} AS BIGINT)"
    fits = f"CAST({tiny} AS DOUBLE) = CAST({text} AS DOUBLE)"
    return {
        "lo": f"sum(IF({whole}, {bits} & 1048575L, NULL))",
        "hi": f"sum(IF({whole}, shiftright({bits}, 20), NULL))",
        "a": other(f"CASE WHEN {size} >= 0.1D THEN NULL WHEN {fits} THEN {fine(tiny)} ELSE CAST({raised} AS DECIMAL(26,0)) END", fine(tail)),
        "b": other(f"CASE WHEN {size} < 0.1D THEN {places(near(tiny))} WHEN {size} < 1E16D THEN {places(f'CAST({mid} - {units} AS DECIMAL(19,18))')} END", places(near(tail))),
        "c": other(
            f"CASE WHEN {size} < 0.1D THEN {_dec(0)} WHEN {size} < 1E16D THEN CAST({units} AS DECIMAL(38,0)) WHEN {size} < 1E38D THEN CAST({fewest} AS DECIMAL(38,0))"
            f" ELSE CAST({raised} AS DECIMAL(38,0)) END", f"CAST({v} - {v} % 1BD AS DECIMAL(38,0))", f"CAST({v} AS DECIMAL(38,0))",
        ),
        "odd": f"sum(IF({odd}, {real}, NULL))",
    }


def merge(s: str) -> dict[str, str]:
    """The aggregates that add states; ``s`` is SQL of a state."""
    return {f: f"sum({s}.{f})" for f in FIELDS}


def struct(fields: dict[str, str]) -> str:
    return f"named_struct({', '.join(f'{k!r}, {v}' for k, v in fields.items())})"


def _zero(x: str) -> str:
    return f"coalesce(CAST({x} AS DECIMAL(38,0)), {_dec(0)})"


def _floored(x: str, by: int) -> str:
    return f"CAST(({x} - pmod({x}, {_dec(by)})) / {_dec(by)} AS DECIMAL(38,0))"


def _whole(x: str) -> str:
    return f"CAST({x} AS DECIMAL(38,0))"


def _joined(s: str, body: str) -> str:
    """``body`` with ``j.whole`` and ``j.rest``: the sum is whole + rest / 10^36, 0 <= rest < 10^36."""
    b = _whole(f"{_zero(f'{s}.b')} + {_floored(_zero(f'{s}.a'), E18)}")
    big = _whole(f"{_zero(f'{s}.hi')} * {_dec(1 << 20)} + {_zero(f'{s}.lo')}")
    rest = _whole(f"pmod(i.b, {_dec(E18)}) * {_dec(E18)} + pmod({_zero(f'{s}.a')}, {_dec(E18)}) + pmod(i.big, {_dec(100)}) * {_dec(10**34)}")
    whole = _whole(f"{_zero(f'{s}.c')} + {_floored('i.b', E18)} + {_floored('i.big', 100)}")
    carry = f"IF(k.rest >= {_dec(E36)}, {_dec(1)}, {_dec(0)})"
    one = f"named_struct('whole', {_whole(f'k.whole + {carry}')}, 'rest', {_whole(f'k.rest - {carry} * {_dec(E36)}')})"
    return let("i", f"named_struct('b', {b}, 'big', {big})", let("k", f"named_struct('whole', {whole}, 'rest', {rest})", let("j", one, body)))


def _absolute(s: str, body: str) -> str:
    """``body`` with ``m.minus``, ``m.whole`` and ``m.rest``, those of the sum's absolute value."""
    rest = _whole(f"IF(j.whole < 0BD AND j.rest > 0BD, {_dec(E36)} - j.rest, j.rest)")
    # 0 - x, as the minus sign rounds decimals of more than 34 digits
    whole = _whole(f"IF(j.whole < 0BD, {_dec(0)} - j.whole - IF(j.rest > 0BD, 1BD, 0BD), j.whole)")
    return _joined(s, let("m", f"named_struct('minus', j.whole < 0BD, 'whole', {whole}, 'rest', {rest})", body))


def _finish(s: str, cents: str | None, odd: str, other: str) -> str:
    """Null when nothing was added; ``cents`` where there are only cents, in number what a double holds exactly; ``odd`` with NaN or infinities."""
    short = f"WHEN coalesce({s}.a, {s}.b, {s}.c) IS NULL AND {s}.odd IS NULL AND abs({s}.hi) < 8589934592L THEN {cents} " if cents else ""
    return f"CASE WHEN coalesce(CAST({s}.lo AS DOUBLE), CAST({s}.c AS DOUBLE), {s}.odd) IS NULL THEN NULL {short}WHEN {s}.odd IS NOT NULL THEN {odd} ELSE {other} END"


def _cents(s: str) -> str:
    return f"({s}.hi * 1048576L + {s}.lo)"


_DIGITS = "concat(IF(m.minus, '-', ''), CAST(m.whole AS STRING), '.', lpad(CAST(m.rest AS STRING), 36, '0'))"


def as_double(s: str) -> str:
    """The double nearest to the sum; ``s`` is SQL of a state."""
    return _finish(s, f"{_cents(s)} / 100D", f"{s}.odd", _absolute(s, f"CAST({_DIGITS} AS DOUBLE)"))


def as_text(s: str) -> str:
    """All digits of the sum."""
    return _finish(s, None, f"CAST({s}.odd AS STRING)", _absolute(s, f"regexp_replace({_DIGITS}, '[.]?0+$', '')"))


def as_decimal(s: str, type_: str, scale: int) -> str:
    """The sum as a decimal; raises if it does not fit."""
    error = f"CAST(raise_error(concat('sum does not fit {type_}: ', t)) AS {type_})"
    exact = let("t", _DIGITS, f"IF(CAST(substr(t, {scale - 36}) AS DECIMAL(38,0)) = 0BD, coalesce(TRY_CAST(substr(t, 1, length(t) - {36 - scale}) AS {type_}), {error}), {error})")
    return _finish(s, None, f"CAST(raise_error('sum does not fit {type_}') AS {type_})", _absolute(s, exact))


def rounded(s: str, digits: int) -> str:
    """The sum rounded half away from zero, as a double."""
    unit, top = 10 ** (36 - digits), _dec(10**digits)
    up = _floored(_whole(f"m.rest + {_dec(unit // 2)}"), unit)  # steps after the point; as many as make a whole if it rounds up to one
    shown = f"CAST(concat(IF(m.minus, '-', ''), CAST(m.whole + IF(u >= {top}, 1BD, 0BD) AS STRING), '.', lpad(CAST(pmod(u, {top}) AS STRING), {max(digits, 1)}, '0')) AS DOUBLE)"
    return _finish(s, f"{_cents(s)} / 100D" if digits >= 2 else None, f"{s}.odd", _absolute(s, let("u", up, shown)))


def order_key(s: str) -> str:
    """A struct that sorts as the sums do, NaN and infinities by their place among doubles; null when nothing was added."""
    none, place = "CAST(0 AS DECIMAL(38,0))", f"CASE WHEN isnan({s}.odd) THEN 2 WHEN {s}.odd > 0D THEN 1 ELSE -1 END"
    odd = f"named_struct('side', {place}, 'whole', {none}, 'rest', {none})"
    cents = f"named_struct('side', 0, 'whole', {_whole(f'({_cents(s)} - pmod({_cents(s)}, 100L)) div 100L')}, 'rest', {_whole(f'CAST(pmod({_cents(s)}, 100L) AS DECIMAL(3,0)) * {_dec(10**34)}')})"
    return _finish(s, cents, odd, _joined(s, "named_struct('side', 0, 'whole', j.whole, 'rest', j.rest)"))


def mean(s: str, n: str, digits: int) -> str:
    """The sum over ``n``, rounded half away from zero to ``digits`` places, as a double; null for n = 0.

    With T the sum's absolute value, that is floor((floor(2 * 10^digits * T) + n) / 2n): whole numbers throughout. From
    10^30 on, where a mean of fewer than 10^14 values has no places left in a double, it is the quotient of doubles.
    """
    count, step = f"CAST({n} AS DECIMAL(20,0))", 10**digits
    whole = let("y", f"named_struct('whole', m.whole, 'rest', m.rest, 'n', {count})", "named_struct('each', CAST((y.whole - y.whole % y.n) / y.n AS DECIMAL(38,0)), 'over', CAST(y.whole % y.n AS DECIMAL(20,0)), 'rest', y.rest, 'n', y.n)")
    places = _floored(_floored("x.rest", 10 ** (36 - digits - 1)), 5)
    up = let("z", f"named_struct('up', {_whole(f'x.over * {_dec(2 * step)} + {places} + x.n')}, 'by', {_whole('x.n + x.n')})", "CAST((z.up - z.up % z.by) / z.by AS DECIMAL(38,0))")
    shown = f"CAST(concat(CAST(q.each + IF(q.up >= {_dec(step)}, 1BD, 0BD) AS STRING), '.', lpad(CAST(pmod(q.up, {_dec(step)}) AS STRING), {max(digits, 1)}, '0')) AS DOUBLE)"
    exact = let("x", whole, let("q", f"named_struct('each', x.each, 'up', {up})", shown))
    either = f"IF(m.minus, -1D, 1D) * CASE WHEN m.whole < {_dec(10**30)} THEN {exact} ELSE CAST(m.whole AS DOUBLE) / {n} END"
    short = f"sign({_cents(s)}) * ((2L * abs({_cents(s)}) + {n}) div (2L * {n})) / 100D" if digits == 2 else None
    return f"IF({n} = 0, NULL, {_finish(s, short, f'{s}.odd / {n}', _absolute(s, either))})"
