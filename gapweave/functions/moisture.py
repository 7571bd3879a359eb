"""Physical conversions: units, wind, humidity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Physical constants and unit factors of the published formulas.
ZERO_CELSIUS_K = 273.15
SECONDS_PER_HOUR = 3600.0
MM_PER_M = 1000.0
J_PER_MJ = 1.0e6
HALF_HOURS_PER_HOUR = 2.0
FULL_CIRCLE_DEG = 360.0
STANDARD_PRESSURE_PA = 101325.0
SONNTAG_1990 = (0.6112, 17.62, 243.12)  # kPa, -, degC
BOLTON_1980 = (6.112, 17.67, 243.5)  # hPa, -, degC
DRY_TO_VAPOUR = (0.622, 0.378)


def kelvin_to_celsius(t: Column) -> Column:
    return t - ZERO_CELSIUS_K


def metres_to_mm(x: Column) -> Column:
    return x * MM_PER_M


def joules_to_watts(hourly: Column) -> Column:
    """Energy per square metre summed over an hour -> mean flux."""
    return hourly / SECONDS_PER_HOUR


def megajoules_to_joules(x: Column) -> Column:
    return x * J_PER_MJ


def half_hour_amount_to_rate(x: Column) -> Column:
    """mm collected in half an hour -> mm per hour."""
    return x * HALF_HOURS_PER_HOUR


def half_hour_rate_to_amount(x: Column) -> Column:
    """mm per hour held for half an hour -> mm."""
    return x / HALF_HOURS_PER_HOUR


def signed_longitude(lon: Column) -> Column:
    """Grids counted 0..360 eastward -> the western, negative branch."""
    return lon - FULL_CIRCLE_DEG


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def _magnus(t: Column, coefficients: tuple[float, float, float]) -> Column:
    base, slope, offset = coefficients
    return F.lit(base) * F.exp(F.lit(slope) * t / (t + F.lit(offset)))


def saturation_pressure(t: Column) -> Column:
    """Saturation vapour pressure in kPa at ``t`` degC."""
    return _magnus(t, SONNTAG_1990)


def deficit_from_dew_point(t: Column, dew: Column) -> Column:
    return saturation_pressure(t) - saturation_pressure(dew)


def deficit_from_humidity(t: Column, rh_percent: Column) -> Column:
    return saturation_pressure(t) * (1 - rh_percent / 100)


def specific_humidity(rh_fraction: Column, t: Column, pressure_pa: Column | None = None) -> Column:
    """kg water per kg moist air.  Valid for ``t >= 0``; see ``operators.checks``."""
    pressure_pa = F.lit(STANDARD_PRESSURE_PA) if pressure_pa is None else pressure_pa
    ratio, share = DRY_TO_VAPOUR
    vapour_hpa = rh_fraction * _magnus(t, BOLTON_1980)
    return F.lit(ratio) * vapour_hpa / (pressure_pa / 100 - F.lit(share) * vapour_hpa)


def not_negative(x: Column) -> Column:
    """Clamp at zero; NULL stays NULL."""
    return F.when(x < 0, F.lit(0.0)).otherwise(x)


def conductance_curve(psi: Column, psi_max: Column | float = -0.1) -> Column:
    """Stomatal response: 1 at zero potential, one half at ``psi_max``, falling towards zero below."""
    top = F.lit(psi_max) if isinstance(psi_max, float) else psi_max
    return top / (psi + top)
