"""Fixed dimensions: the city list (A8) and the weather-code texts.

Both are literal, tiny and of a known size, so joining them with
``F.broadcast`` is safe at any fact-table scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake import schemas

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's lists for identical results).
# City list in its original order: (city, country code).
CITIES = [
    ("Berlin", "DE"),
    ("Paris", "FR"),
    ("Rome", "IT"),
    ("Madrid", "ES"),
    ("Warsaw", "PL"),
    ("Vienna", "AT"),
    ("Budapest", "HU"),
    ("Bucharest", "RO"),
    ("Lisbon", "PT"),
]
# Local spellings of these cities that payload services return.
CITY_ALIASES = {
    "Roma": "Rome",
    "Warszawa": "Warsaw",
    "Wien": "Vienna",
    "Bucuresti": "Bucharest",
    "București": "Bucharest",
    "Lisboa": "Lisbon",
}
# WMO weather interpretation codes and their texts.
WEATHER_CODES = {
    0: "Clear sky",
    1: "Mainly clear",
    2: "Partly cloudy",
    3: "Overcast",
    45: "Fog",
    48: "Depositing rime fog",
    51: "Light drizzle",
    53: "Moderate drizzle",
    55: "Dense drizzle",
    56: "Light freezing drizzle",
    57: "Dense freezing drizzle",
    61: "Slight rain",
    63: "Moderate rain",
    65: "Heavy rain",
    66: "Light freezing rain",
    67: "Heavy freezing rain",
    71: "Slight snow fall",
    73: "Moderate snow fall",
    75: "Heavy snow fall",
    77: "Snow grains",
    80: "Slight rain showers",
    81: "Moderate rain showers",
    82: "Violent rain showers",
    85: "Slight snow showers",
    86: "Heavy snow showers",
    95: "Thunderstorm",
    96: "Thunderstorm with slight hail",
    99: "Thunderstorm with heavy hail",
}
# Country codes accepted by the published data tests.
ACCEPTED_COUNTRIES = ["DE", "FR", "ES", "IT", "PL", "NL", "BE", "AT", "CH", "CZ"]
# End of fixed values.
# ---------------------------------------------------------------------------

# City coordinates (ours; Berlin's is the one seen in the sample records).
CITY_COORDINATES = {
    "Berlin": (52.52437, 13.41053),
    "Paris": (48.85341, 2.3488),
    "Rome": (41.89193, 12.51133),
    "Madrid": (40.4165, -3.70256),
    "Warsaw": (52.22977, 21.01178),
    "Vienna": (48.20849, 16.37208),
    "Budapest": (47.49835, 19.04045),
    "Bucharest": (44.43225, 26.10626),
    "Lisbon": (38.71667, -9.13333),
}


def city_rows() -> list[tuple]:
    return [(i, c, k, *CITY_COORDINATES[c]) for i, (c, k) in enumerate(CITIES)]


def _sql_literal(v) -> str:
    return "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else repr(v)


def city_array():
    """The city list as a constant ``array<struct>`` (for expression lookups),
    built as one SQL expression (one parse instead of dozens of literals)."""
    types = {"ord": "INT", "latitude": "DOUBLE", "longitude": "DOUBLE"}
    structs = []
    for row in city_rows():
        fields = ", ".join(f"'{f.name}', CAST({_sql_literal(v)} AS {types.get(f.name, 'STRING')})"
                           for v, f in zip(row, schemas.DIM_CITY.fields))
        structs.append(f"named_struct({fields})")
    return F.expr(f"array({', '.join(structs)})")


def literal_table(spark: SparkSession, schema, rows: list[tuple]) -> DataFrame:
    """A small constant table planned as a local relation (no Python RDD)."""
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
               for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def dim_city(spark: SparkSession) -> DataFrame:
    """``ord, city_name, country, latitude, longitude`` (9 rows)."""
    return literal_table(spark, schemas.DIM_CITY, city_rows())


def dim_weather_code(spark: SparkSession) -> DataFrame:
    """``weather_code, weather`` (28 rows)."""
    return literal_table(spark, schemas.DIM_WEATHER_CODE, sorted(WEATHER_CODES.items()))


def weather_text(code_col) -> "F.Column":
    """Code -> text as an in-expression map lookup (NULL when unknown).

    Stays inside whole-stage codegen; no join needed for a 28-entry map.
    """
    pairs = ", ".join(f"{code}, {_sql_literal(text)}" for code, text in sorted(WEATHER_CODES.items()))
    return F.expr(f"map({pairs})")[code_col]


def countries(spark: SparkSession) -> DataFrame:
    """Distinct countries, first city in list order wins."""
    return first_city_per_country(dim_city(spark))


def first_city_per_country(cities: DataFrame) -> DataFrame:
    """One row per country, the lowest ``ord`` wins.

    ``min_by`` aggregates map-side, so no group is ever gathered whole.
    """
    return (cities.groupBy("country")
            .agg(F.min_by(F.struct("ord", "city_name"), "ord").alias("first"))
            .select("country", F.col("first.city_name").alias("city_name"),
                    F.col("first.ord").alias("ord")))


def city_aliases(spark: SparkSession) -> DataFrame:
    """``query, rank, city_name`` candidates: the fixed local spellings."""
    schema = T.StructType([T.StructField("query", T.StringType()), T.StructField("rank", T.IntegerType()),
                           T.StructField("city_name", T.StringType())])
    return literal_table(spark, schema, [(k, 0, v) for k, v in sorted(CITY_ALIASES.items())])


def canonical_city_names(rows: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """Local spellings of a city (``Wien``) become its listed name.

    The hourly join matches on the name, so every source takes the name of
    the top-ranked candidate for it; names without a candidate stay, so
    further cities of a country keep their own.  The default candidates are
    a handful of literal rows; a caller's table is joined by its size.
    """
    from gridlake.operators.firsts import resolve_entities
    given = candidates if candidates is not None else city_aliases(rows.sparkSession)
    given = given.select(F.col("query").alias("_query"), "rank", F.col("city_name").alias("_name"))
    resolved = resolve_entities(rows.withColumn("_query", F.col("city_name")), given, "_query")
    cols = [F.coalesce("_name", "city_name").alias("city_name") if c == "city_name" else F.col(c) for c in rows.columns]
    return resolved.select(*cols)
