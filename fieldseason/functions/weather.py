"""Weather expressions."""

# Degree-day bounds and day thresholds in °F.
GDD_BASE_F = 50.0
GDD_CAP_F = 86.0
FROST_F = 32.0
HEAT_F = 95.0


def suspect(attributes: str) -> str:
    """True when the second comma token of the quality attributes is not blank."""
    return f"coalesce(trim(get(split({attributes}, ','), 1)) != '', false)"


def quality_flag(any_suspect: str, present: str) -> str:
    return f"case when {present} = 0 then 'MISSING' when {any_suspect} then 'SUSPECT' else 'OK' end"


def fahrenheit(celsius: str) -> str:
    return f"{celsius} * 9D / 5D + 32D"


def inches(millimetres: str) -> str:
    return f"{millimetres} / 25.4D"


def growing_degrees(
    tmax: str, tmin: str, base: float = GDD_BASE_F, cap: float = GDD_CAP_F
) -> str:
    """Degree days of one day, null when a temperature is null.

    Only the high is capped and only the low is floored; the result is not below 0.
    """
    mean = f"(least({tmax}, {cap}D) + greatest({tmin}, {base}D)) / 2D"
    return (
        f"case when {tmax} is not null and {tmin} is not null"
        f" then greatest(0D, {mean} - {base}D) end"
    )


def frost_free(tmin: str, threshold: float = FROST_F) -> str:
    """1 or 0; a missing low counts as 0."""
    return f"case when {tmin} > {threshold}D then 1 else 0 end"


def heat_stress(tmax: str, threshold: float = HEAT_F) -> str:
    """1 or 0; a missing high counts as 0."""
    return f"case when {tmax} > {threshold}D then 1 else 0 end"


def condition(drought: str, heat_days: str) -> str:
    """Stress, Watch or Normal; an unknown measure counts as zero."""
    index, days = f"coalesce({drought}, 0D)", f"coalesce({heat_days}, 0)"
    return (
        f"case when {index} < -0.2D or {days} > 20 then 'Stress'"
        f" when {index} < 0 or {days} > 10 then 'Watch' else 'Normal' end"
    )
