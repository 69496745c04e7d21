"""Names to entities from landed candidate lists.

A geocoder's answer for a queried name is a ranked list of candidates
(name, country, coordinates, population).  ``read_candidates`` reads the
landed answers; ``candidate_index`` keys them by the normalised name (case,
accents, punctuation and white space do not count) of the query and of the
candidate itself, one best candidate per (name, country) and per name;
``resolve_names`` joins rows with the index.

Choice among candidates of one name, in this order: one of the country that
the row says, one whose own name is the asked one, the service's rank, the
larger population, the name.  The index is reduced to one row per key before
the join, so a name with many candidates never multiplies rows.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.sources.storage import exists

CANDIDATES = "query string, results array<struct<name:string,country_code:string,latitude:double,longitude:double,population:long>>"
ENTITY = ["name", "country_code", "latitude", "longitude"]


def _accents() -> tuple[str, str]:
    """Latin letters with marks (U+00C0 to U+024F) and their base letters, by decomposition."""
    pairs = [(chr(c), unicodedata.normalize("NFD", chr(c))[0]) for c in range(0xC0, 0x250)]
    pairs = [(a, b) for a, b in pairs if a != b and b.isascii()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


#: Letters that decompose into no base letter.
SPELLED = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "l", "đ": "d"}


def normalised_name(name) -> Column:
    """Lower-case, without accents, letters and digits joined by single spaces; null for nothing left."""
    marked, plain = _accents()
    # marks that stand alone (decomposed text) go as well
    out = F.regexp_replace(F.translate(F.lower(F.col(name) if isinstance(name, str) else name), marked.lower(), plain.lower()),
                           r"[̀-ͯ]", "")
    for letter, base in SPELLED.items():
        out = F.replace(out, F.lit(letter), F.lit(base))
    out = F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))
    return F.when(out != "", out)


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """(query, rank, name, country_code, latitude, longitude, population) of
    the landed answers; names without any candidate give no row."""
    landed = spark.read.schema(CANDIDATES).json(path) if exists(spark, path) else spark.createDataFrame([], CANDIDATES)
    return landed.select("query", F.posexplode("results").alias("rank", "r")).select("query", "rank", "r.*") \
        .where("name is not null")


def candidate_index(candidates: DataFrame) -> DataFrame:
    """(key, country, name, country_code, latitude, longitude): the best
    candidate of each normalised name, and of each with its country
    (``country`` null: whatever the country)."""
    own = normalised_name("name")
    keys = F.array_distinct(F.array(normalised_name("query"), own))
    rows = candidates.select("*", F.explode(keys).alias("key")).where("key is not null")
    order = F.struct((normalised_name("name") != F.col("key")).alias("other"), "rank",
                     (-F.coalesce("population", F.lit(0).cast("long"))).alias("less"), "name", "country_code", "latitude", "longitude")
    scoped = rows.withColumn("country", F.explode(F.array_distinct(F.array(F.lit(None).cast("string"), F.col("country_code")))))
    best = scoped.groupBy("key", "country").agg(F.min_by(F.struct(*ENTITY), order).alias("best"))
    return best.select("key", "country", "best.*")


def resolve_names(rows: DataFrame, index: DataFrame, name_col: str = "city_name", country_col: str | None = "country") -> DataFrame:
    """``rows`` plus ``resolved_name, resolved_country, latitude, longitude``
    (null where no candidate matches).  The row's own country decides first;
    a candidate of another country is taken only for rows without one."""
    named = [F.col("name").alias("resolved_name"), F.col("country_code").alias("resolved_country"),
             F.col("latitude").alias("latitude"), F.col("longitude").alias("longitude")]
    entry = index.select(F.col("key").alias("_key"), F.col("country").alias("_country"), *named)
    given = rows.withColumn("_name", normalised_name(name_col))
    country = F.col(country_col) if country_col else F.lit(None).cast("string")
    out = given.withColumn("_in", country)
    met = out.join(entry, (F.col("_name") == F.col("_key")) & F.col("_in").eqNullSafe(F.col("_country")), "left")
    return met.drop("_name", "_in", "_key", "_country")
