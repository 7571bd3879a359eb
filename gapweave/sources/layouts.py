"""Names and units of the input files.  Everything in this module is a fixed value."""

from __future__ import annotations

from dataclasses import dataclass, field

CALENDAR = {"Dia": "day", "Mês": "month", "Ano": "year", "Hora": "clock"}

# Station log 2001-2016, one time stamp column.
LOG_2001 = {
    "Date": "date",
    "Temp (deg C)": "t28m",
    "Rh (%)": "rh28m",
    "RAD (W/m2)": "rad_global",
    "PPT (mm)": "precip",
}

# Station logs 2016 and 2017.
LOG_2016 = {
    **CALENDAR,
    "Tar_2m": "t2m",
    "Tar_16m": "t16m",
    "Tar_28m": "t28m",
    "Tar_42m": "t42m",
    "UR_2m": "rh2m",
    "UR_16m": "rh16m",
    "UR_28m": "rh28m",
    "UR_42m": "rh42m",
    "Chuva": "precip",
    "ETP_42": "et42m",
    "Rso": "rso",
    "VV": "vv",
    "VV_max": "vv_max",
    "DD": "direction",
    "RG": "rad_global",
    "RGT": "rad_glob_tot",
    "NET": "rad_net",
}

# Station log 2018: units in the names, one double space.
LOG_2018 = {
    **CALENDAR,
    "Tar_2m (°C)": "t2m",
    "Tar_16m (°C)": "t16m",
    "Tar_28m (°C)": "t28m",
    "Tar_42m (°C)": "t42m",
    "UR  2m (%)": "rh2m",
    "UR_16m (%)": "rh16m",
    "UR_28m (%)": "rh28m",
    "UR_42m (%)": "rh42m",
    "Chuva (mm)": "precip",
    "ETP_42": "et42m",
    "Rso (W/m²)": "rso",
    "VV (m/s)": "vv",
    "VV_max (m/s)": "vv_max",
    "DD (Graus)": "direction",
    "RG (W/m²)": "rad_global",
    "RGT (MJ/m²)": "rad_glob_tot",
    "NET (W/m²)": "rad_net",
}

# Station log 2019: no wind.
LOG_2019 = {
    **CALENDAR,
    "Tar_2m (°C)": "t2m",
    "Tar_16m (°C)": "t16m",
    "Tar_28m (°C)": "t28m",
    "Tar_42m (°C)": "t42m",
    "RH_2m (%)": "rh2m",
    "RH_16m (%)": "rh16m",
    "RH_28m (%)": "rh28m",
    "RH_42m (%)": "rh42m",
    "Chuva (mm)": "precip",
    "ETP_42m": "et42m",
    "Rso": "rso",
    "RG (W/m²)": "rad_global",
    "RGT (MJ/m²)": "rad_glob_tot",
    "NET (W/m²)": "rad_net",
}

# Station log 2021-2023: dew points and vapour pressures too.
LOG_2021 = {
    **CALENDAR,
    "Tar_2m (°C)": "t2m",
    "Tar_16m (°C)": "t16m",
    "Tar_28m (°C)": "t28m",
    "Tar_42m (°C)": "t42m",
    "Td_2m (°C)": "d2m",
    "Td_16m (°C)": "d16m",
    "Td_28m (°C)": "d28m",
    "Td_42m (°C)": "d42m",
    "RH_2m (%)": "rh2m",
    "RH_16m (%)": "rh16m",
    "RH_28m (%)": "rh28m",
    "RH_42m (%)": "rh42m",
    "PSV_ 2m (mbar)": "vp2m",
    "PSV_ 16m (mbar)": "vp16m",
    "PSV_ 28m (mbar)": "vp28m",
    "PSV_ 42m (mbar)": "vp42m",
    "RG (W/m²)": "rad_global",
    "NET (W/m²)": "rad_net",
    "Chuva (mm)": "precip",
}

# Columns of the harmonised station record.
STATION_COLUMNS = (
    "t28m", "rh28m", "rad_global", "precip",
    "t2m", "rh2m", "t16m", "rh16m", "t42m", "rh42m", "et42m",
    "rso", "rad_glob_tot", "rad_net", "vv", "vv_max", "direction",
)

# Hourly reanalysis export.
REANALYSIS = {
    "site": "site",
    "date": "date",
    "temperature_2m": "t2m",
    "dewpoint_temperature_2m": "d2m",
    "surface_pressure": "ps",
    "surface_solar_radiation_downwards": "ssrd",
    "surface_thermal_radiation_downwards": "strd",
    "total_evaporation_hourly": "tot_evap",
    "u_component_of_wind_10m": "u",
    "v_component_of_wind_10m": "v",
    "total_precipitation": "total_precipitation",
}
REANALYSIS_KEEP_NAMES = ("date", "site", "time_utc", "time_local", "hour", "month", "year")

# Half-hourly satellite rain (mm per hour) and daily blended rain (mm per day).
SATELLITE_RAIN = {"date": "date", "precipitationCal": "precip", "site": "site"}
DAILY_RAIN = {"date": "date", "precipitation": "c_p24h", "site": "site"}

# Columns an export adds and nobody needs.
EXPORT_ONLY = ("system:index", ".geo")

# Trailing rain sums: hours of the half-hourly product, days of the daily one.
RAIN_HOURS = (3, 6, 12, 24, 48, 120)
RAIN_DAYS = {"c_p48h": 2, "c_p120h": 5}

# Model targets.
TARGETS = ("t28m", "vpd28m", "rh28m", "rad_global", "precip", "vv")


@dataclass(frozen=True)
class Log:
    """One station log: its names, and factors that bring it to common units."""

    names: dict[str, str]
    factors: dict[str, float] = field(default_factory=dict)


# Half-hour rain amounts become rates; hourly means of the last log stay as they are.
LOGS = {
    "2001": Log(LOG_2001, {"precip": 2.0}),
    "2016": Log(LOG_2016, {"precip": 2.0}),
    "2017": Log(LOG_2016, {"precip": 2.0}),
    "2018": Log(LOG_2018, {"precip": 2.0}),
    "2019": Log(LOG_2019, {"precip": 2.0}),
    "2021": Log(LOG_2021),
}
