"""Weather scalar functions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..core.frames import _c

# Heat-index polynomial, (coefficient, power of T, power of RH).
HEAT_INDEX_TERMS = (
    (-42.379, 0, 0), (2.04901523, 1, 0), (10.14333127, 0, 1), (-0.22475541, 1, 1), (-0.00683783, 2, 0),
    (-0.05481717, 0, 2), (0.00122874, 2, 1), (0.00085282, 1, 2), (-0.00000199, 2, 2),
)


def clip(x: Column | str, lo: float | None = None, hi: float | None = None) -> Column:
    """Bound a value; null stays null."""
    c = _c(x)
    out = c
    if lo is not None:
        out = F.when(out < lo, F.lit(float(lo))).otherwise(out)
    if hi is not None:
        out = F.when(out > hi, F.lit(float(hi))).otherwise(out)
    return out


def heat_index_f(temp: Column | str, humidity: Column | str) -> Column:
    """Heat index where it is hot and humid, the temperature elsewhere."""
    t, rh = _c(temp), clip(humidity, 0, 100)
    total = F.lit(0.0)
    for k, pt, pr in HEAT_INDEX_TERMS:
        term = F.lit(k)
        for _ in range(pt):
            term = term * t
        for _ in range(pr):
            term = term * rh
        total = total + term
    return F.when((t >= 80) & (rh >= 40), total).otherwise(t)


def angle_delta(direction: Column | str, centre: float) -> Column:
    """Signed angle from ``centre`` in [-180, 180)."""
    return F.pmod(_c(direction) - F.lit(centre) + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def solar_hour_shape(hour: Column | str) -> Column:
    return clip(F.sin(F.lit(math.pi) * (_c(hour) - 6.0) / 12.0), 0.0, 1.0)


def solar_season_factor(day_of_year: Column | str) -> Column:
    return clip(0.825 + 0.175 * F.cos(F.lit(2.0 * math.pi) * (_c(day_of_year) - 172.0) / 365.25), 0.60, 1.05)




def half_life_decay(lead: Column, half_life: float) -> Column:
    return F.pow(F.lit(0.5), lead / F.lit(half_life))


def exp_decay(lead_hours: Column, scale_hours: float, floor: float = 0.0) -> Column:
    """exp(-(h-1)/scale), never under ``floor``."""
    return F.greatest(F.exp(-(lead_hours - 1) / F.lit(scale_hours)), F.lit(floor))


def _unit_key(unit: Column | str) -> Column:
    u = F.lower(F.trim(_c(unit)))
    return F.replace(F.replace(F.replace(F.replace(u, F.lit("²"), F.lit("2")), F.lit("^2"), F.lit("2")),
                               F.lit("°"), F.lit("")), F.lit(" "), F.lit(""))


def irradiance_kwh_m2(value: Column | str, unit: Column | str) -> Column:
    """Hourly or summed irradiance in kWh/m2; an unknown unit fails the job."""
    v, u = _c(value), _unit_key(unit)
    bad = F.raise_error(F.concat(F.lit("irradiance unit not supported: "), _c(unit))).cast("double")
    return (F.when(u.isin("w/m2", "wm2", "wh/m2"), v / 1000.0).when(u == "kwh/m2", v)
            .when(u == "mj/m2", v / 3.6).otherwise(bad))


def celsius(value: Column | str, unit: Column | str) -> Column:
    v, u = _c(value), _unit_key(unit)
    return (F.when(u.isin("f", "degf", "fahrenheit"), (v - 32.0) * (5.0 / 9.0))
            .when(u.isin("k", "kelvin"), v - 273.15).otherwise(v))


def metres_per_second(value: Column | str, unit: Column | str) -> Column:
    v, u = _c(value), _unit_key(unit)
    return (F.when(u.isin("km/h", "kmh", "kph"), v / 3.6).when(u.isin("mph", "mi/h"), v * 0.44704)
            .when(u.isin("kn", "knot", "knots"), v * 0.514444).otherwise(v))


def panel_azimuth(compass_degrees: Column | str) -> Column:
    """Compass azimuth (180 = south) to panel azimuth (0 = south, west positive)."""
    return angle_delta(compass_degrees, 180.0)
