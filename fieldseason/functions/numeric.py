"""Sums and roundings that do not depend on the order in which rows arrive.

A double sum changes in its last bits with the order of the partial sums, and a
season total often lies exactly on a rounding tie, so a re-run after a lost
executor could print another digit. Totals are therefore kept in two integers, whole
units and parts of ``10 ** -12``, finer than a double's last digit matters, and rounded
half up by integer division. Each of the two has room for more rows than a year can have.
"""

#: Parts of a unit in which totals are kept.
PARTS = 10**12
#: From here on a value is no measure: it is left out of totals.
LARGEST = 1e12


def measured(value: str) -> str:
    """The value, or null where it is not finite or as large as no measure is."""
    return f"case when abs({value}) < {LARGEST:.0f}D then {value} end"


def whole(value: str) -> str:
    """Whole units of a measured value, rounded down."""
    return f"floor({measured(value)})"


def parts(value: str) -> str:
    """What ``whole`` leaves, in parts: 0 to ``PARTS``."""
    return f"cast(rint(({measured(value)} - floor({measured(value)})) * {PARTS}D) as bigint)"


def round_total(units: str, rest: str, digits: int, by: str = "1") -> str:
    """``(units + rest / PARTS) / by`` rounded half away from zero, in units of ``10 ** -digits``.

    All are integers, ``rest`` not negative; a zero ``by`` gives null. Nothing overflows while
    ``by`` is below 3 million.
    """
    full, left = f"({units} + {rest} div {PARTS})", f"({rest} % {PARTS})"
    # The size of a negative total: one unit less, and what is missing to it.
    borrow = f"({full} < 0 and {left} > 0)"
    size = f"(case when {borrow} then -{full} - 1 else abs({full}) end * {10**digits})"
    more = f"(case when {borrow} then {PARTS} - {left} else {left} end * {10**digits})"
    none = f"nullif({by}, 0)"
    return (
        f"(case when {full} < 0 then -1 else 1 end * ({size} div {none}"
        f" + (2 * ({size} % {none} * {PARTS} + {more}) + {none} * {PARTS}) div (2 * {none} * {PARTS})))"
    )


def round_ratio(num: str, den: str, digits: int) -> str:
    """``num / den`` rounded half away from zero, in units of ``10 ** -digits``.

    Both arguments are integers; a zero denominator gives null.
    """
    return (
        f"(case when ({num} < 0) != ({den} < 0) then -1 else 1 end"
        f" * ((abs({num}) * {2 * 10**digits} + abs({den})) div nullif(abs({den}) * 2, 0)))"
    )


def decimal_value(units: str, digits: int) -> str:
    """Units of ``10 ** -digits`` as a double."""
    return f"{units} / {10**digits}D"


def to_fixed(value: str, digits: int) -> str:
    """Text with a fixed number of decimals, from the exact binary value, ties up.

    ``format_number`` rounds the exact binary value but sends ties to the even digit,
    and loses a value that rounds up to the first unit. A tie is an odd multiple of
    ``2 ** -(digits + 1)``; it is first moved away from zero by one unit of the digit
    after the last.
    """
    unit, half = 1 / 10**digits, 5 / 10 ** (digits + 1)
    moved = (
        f"case when abs({value}) >= {half}D and abs({value}) < {unit}D"
        f" then signum({value}) * {unit}D"
        f" when abs({value}) * {2 ** (digits + 1)}D % 2 = 1"
        f" then {value} + signum({value}) / {10 ** (digits + 1)}D else {value} end"
    )
    return f"replace(format_number({moved}, {digits}), ',', '')"
