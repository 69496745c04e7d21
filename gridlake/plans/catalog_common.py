"""Shared pieces of the catalog modules: the staged-table SQL and the
energy silver frame over the driver tables."""

from __future__ import annotations

from gridlake.operators.clean import SILVER_ENERGY_COLUMNS, with_date_parts
from gridlake.plans import testbed as tb

E_SQL = tb.STAGE_ENERGY_SQL
W_SQL = tb.STAGE_WEATHER_SQL
ENERGY_COLS = ["city_name", "country", "time", "load_mw"]
YMD_SQL = "CAST(year(time) AS INTEGER) AS year, CAST(month(time) AS INTEGER) AS month, CAST(day(time) AS INTEGER) AS day"


def energy_silver(spark, sf_dir):
    """Silver energy rows (with date parts) of the driver tables."""
    return with_date_parts(tb.stage_energy(spark, sf_dir)).select(*SILVER_ENERGY_COLUMNS)
