"""Exact count, sum and sum of squares of amounts, whatever their size and order.

An amount is a whole number of 10^-9 units. It is held as digits in base 10^8, its square likewise, and digits are
added up as plain 64-bit numbers: such totals don't depend on the order of adding or on how a history is cut, so every
plan gets the same ones (up to 10^10 amounts of one customer). A z-score is compared with its limit in whole numbers:

    z > k  where  n x > S,  n Q > S^2  and  (n x - S)^2 (n - 1) > k^2 n (n Q - S^2)

with n, S, Q the count, sum and sum of squares of the amounts before. Doubles decide it where their error can't matter;
the exact comparison, with digits carried in arrays, runs for the few rows that are left. All is SQL text.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame

BASE, WIDTH = 100_000_000, 8
#: Digits of an amount (38 decimal places) and of a square.
SUM_DIGITS, SQUARE_DIGITS = 5, 10
X = [f"x_{i}" for i in range(SUM_DIGITS)]
XX = [f"xx_{i}" for i in range(SQUARE_DIGITS)]
S = [f"s_{i}" for i in range(SUM_DIGITS)]
Q = [f"q_{i}" for i in range(SQUARE_DIGITS)]
#: Totals by name, and what they add up over ``measured`` rows.
TOTALS = dict(zip(S + Q, X + XX))
N = "n_prior"


# -- digits of single amounts ----------------------------------------------------------
def measured(df: DataFrame) -> DataFrame:
    """Adds the digits of the amount and of its square; NULL where the amount is."""
    small = "CAST(try_cast(amount AS DECIMAL(18,9)) * 1000000000BD AS BIGINT)"  # below 10^9, nearly always
    places = SUM_DIGITS * WIDTH
    # As text: Spark's own arithmetic rounds to 34 digits.
    text = "translate(CAST(CAST(amount AS DECIMAL(38,9)) AS STRING), '-.', '')"
    large = f"CASE WHEN amount >= 1000000000 OR amount <= -1000000000 THEN lpad({text}, {places}, '0') END"
    df = df.selectExpr("*", f"{small} AS _small", f"{large} AS _large")

    def digit(i: int) -> str:
        of_small = ("_small" if i == 0 else f"(_small div {BASE ** i}L)") + (f" % {BASE}L" if i < 2 else "") if i < 3 else "0L"
        piece = f"CAST(substring(_large, {places - WIDTH * (i + 1) + 1}, {WIDTH}) AS BIGINT)"
        return f"CASE WHEN _large IS NULL THEN {of_small} WHEN amount < 0 THEN -{piece} ELSE {piece} END"

    # A missing amount has neither: its digits are NULL too.
    names = [c for c in df.columns if c not in ("_small", "_large")]
    df = df.selectExpr(*names, *[f"CASE WHEN amount IS NOT NULL THEN {digit(i)} END AS {x}" for i, x in enumerate(X)])

    def terms(k: int) -> str:
        pairs = [(i, k - i) for i in range(SUM_DIGITS) if i <= k - i < SUM_DIGITS]
        return "(" + " + ".join(f"{X[i]} * {X[j]}" if i == j else f"2L * {X[i]} * {X[j]}" for i, j in pairs) + ")" if pairs else "0L"

    squares = [f"{terms(k)} % {BASE}L" + (f" + {terms(k - 1)} div {BASE}L" if k else "") for k in range(SQUARE_DIGITS)]
    # Beyond three digits only for large amounts, so the others don't pay for them.
    return df.selectExpr("*", *[f"CASE WHEN {X[3]} = 0 AND {X[4]} = 0 THEN 0L ELSE {s} END AS {q}" if k > SUM_DIGITS else f"{s} AS {q}"
                                for k, (s, q) in enumerate(zip(squares, XX))])


# -- whole numbers of any size, as arrays of digits, the lowest first --------------------
def _let(name: str, value: str, body: str) -> str:
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def carried(a: str) -> str:
    """Digits below BASE and, at the end, what is left over; that one alone may be negative."""
    total = "(c.over + c_x)"
    return (f"aggregate({a}, named_struct('over', 0L, 'digits', CAST(array() AS ARRAY<BIGINT>)), (c, c_x) -> named_struct("
            f"'over', ({total} - pmod({total}, {BASE}L)) div {BASE}L, 'digits', array_append(c.digits, pmod({total}, {BASE}L))),"
            f" c -> array_append(c.digits, c.over))")


def product(a: str, b: str) -> str:
    """Of two carried numbers."""
    term = "get(p_a, p_i) * get(p_b, p_k - p_i)"
    sums = (f"transform(sequence(0, size(p_a) + size(p_b) - 2), p_k -> aggregate("
            f"sequence(greatest(0, p_k - size(p_b) + 1), least(p_k, size(p_a) - 1)), 0L, (p_t, p_i) -> p_t + {term}))")
    return carried(_let("p_a", a, _let("p_b", b, sums)))


def difference(a: str, b: str) -> str:
    return carried(f"zip_with({a}, {b}, (d_a, d_b) -> coalesce(d_a, 0L) - coalesce(d_b, 0L))")


def times(a: str, n: str) -> str:
    """A carried number times a plain one up to 9 * 10^10."""
    return carried(f"transform({a}, t_x -> t_x * {n})")


def positive(a: str) -> str:
    """Is a carried number above zero?"""
    return _let("s_a", a, "(element_at(s_a, -1) > 0 OR element_at(s_a, -1) = 0 AND exists(s_a, s_x -> s_x <> 0))")


def as_double(a: str) -> str:
    return f"aggregate(reverse({a}), 0D, (f, f_x) -> f * {BASE}D + f_x)"


def _constant(n: int) -> str:
    digits = []
    while n or not digits:
        n, digit = divmod(n, BASE)
        digits.append(f"{digit}L")
    return f"array({', '.join(digits)})"


# -- the comparison ----------------------------------------------------------------------
def _floating(names: list[str]) -> str:
    return "(" + " + ".join(f"{n} * 1E{WIDTH * i}D" if i else f"CAST({n} AS DOUBLE)" for i, n in enumerate(names)) + ")"


_SUM, _SQUARES, _VALUE = _floating(S), _floating(Q), _floating(X)
#: n x - S, and n Q - S^2.
_ABOVE = carried("array(" + ", ".join(f"{N} * {x} - {s}" for x, s in zip(X, S)) + ")")
_SPREAD = _let("v_s", carried(f"array({', '.join(S)})"),
               difference(times(carried(f"array({', '.join(Q)})"), N), product("v_s", "v_s")))


def _exactly_above(k: Fraction) -> str:
    left = product(times(product("z_above", "z_above"), f"({N} - 1)"), _constant(k.denominator ** 2))
    right = product(times("z_spread", N), _constant(k.numerator ** 2))
    compared = f"{positive('z_above')} AND {positive('z_spread')} AND {positive(difference(left, right))}"
    return _let("z_above", _ABOVE, _let("z_spread", _SPREAD, compared))


def z_above(limit: float) -> str:
    """Is the amount more than ``limit`` (positive) sample deviations above the mean of those before?"""
    k = Fraction(str(limit))
    kk = f"{float(k * k)!r}D"
    over, spread = f"({N} * {_VALUE} - {_SUM})", f"({N} * {_SQUARES} - {_SUM} * {_SUM})"
    reach = f"({N} * abs({_VALUE}) + abs({_SUM}))"
    apart = f"({over} * {over} * ({N} - 1) - {kk} * {N} * {spread})"
    # Each rounding is below 10^-15 of reach, or of n Q.
    slack = f"1E-12D * ({reach} * {reach} * {N} + {kk} * {N} * {N} * {_SQUARES})"
    return (f"(CASE WHEN {N} < 2 OR x_0 IS NULL THEN false WHEN {over} < -1E-12D * {reach} OR {apart} < -({slack}) THEN false"
            f" WHEN {over} > 1E-12D * {reach} AND {spread} > 1E-12D * {N} * {_SQUARES} AND {apart} > {slack} THEN true"
            f" ELSE {_exactly_above(k)} END)")


#: The score itself, from the exact numbers; NULL where all amounts before are equal.
Z = _let("z_above", _ABOVE, _let("z_spread", _SPREAD, (
    f"CASE WHEN {N} > 1 AND {positive('z_spread')} THEN CASE WHEN {positive('z_above')} THEN 1D ELSE -1D END * "
    f"sqrt({as_double(times(product('z_above', 'z_above'), f'({N} - 1)'))} / {as_double(times('z_spread', N))}) END")))

#: The mean as a double, and the total as a decimal, NULL beyond the type.
MEAN = f"({_SUM} / 1E9D / nullif({N}, 0L))"
_PLAIN = (f"CAST({S[0]} AS DECIMAL(20,0)) * 0.000000001BD + CAST({S[1]} AS DECIMAL(20,0)) * 0.1BD"
          f" + CAST({S[2]} AS DECIMAL(19,0)) * 10000000BD")
_TEXT = "array_join(transform(reverse(w_a), w_x -> lpad(CAST(w_x AS STRING), 8, '0')), '')"
_SIGNED = "CASE WHEN element_at(w_a, -1) < 0 THEN NULL ELSE concat(left(w_t, length(w_t) - 9), '.', right(w_t, 9)) END"
_WIDE = _let("w_a", carried(f"array({', '.join(S)})"), _let("w_t", _TEXT, _SIGNED))
_WIDE_BELOW = _let("w_a", carried("array(" + ", ".join(f"-{s}" for s in S) + ")"), _let("w_t", _TEXT, _SIGNED))
TOTAL = (f"(CASE WHEN {S[3]} = 0 AND {S[4]} = 0 THEN CAST({_PLAIN} AS DECIMAL(38,9))"
         f" ELSE try_cast(coalesce({_WIDE}, concat('-', {_WIDE_BELOW})) AS DECIMAL(38,9)) END)")
