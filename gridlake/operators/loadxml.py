"""Load documents (XML) -> hourly load.

Each landed row holds one document: ``TimeSeries[] -> Period[] ->
{timeInterval.start, resolution, Point[]{position, quantity}}``.
``from_xml`` parses it with a fixed schema (namespace ignored); periods
are exploded, and the downsampling to hourly means runs on the point
array of each period with higher-order functions, inside the task that
holds the document - points are never shuffled.

Rules (faithful to the source loader):
* a period without a start is skipped; a missing resolution means PT60M;
* ``PT<n>M`` gives ``60 div n`` points per hour, other shapes 1;
* points whose quantity is missing or not a plain number are skipped and do not
  count, so later points move up (``by_position=False``, the default);
* a period with a finite quantity that is too large to publish is rejected
  whole, with a reason: leaving the point out would shift the later hours;
  ``by_position=True`` places points by their ``position`` instead;
* consecutive blocks of n points make one hour, a trailing partial block
  is dropped; hour i starts at ``start + i hours``;
* the mean is rounded half-up to 2 decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.functions.numeric import TOTAL_DECIMAL, exact, half_up_mean, measure, over_limit
from gridlake.functions.resolution import points_per_hour, resolution_reason
from gridlake.functions.timefmt import parse_iso
from gridlake.sources.payloads import file_origin

XML_OPTIONS = {"ignoreNamespace": "true", "mode": "PERMISSIVE"}


def parse_documents(landed: DataFrame, xml_col: str = "xml") -> DataFrame:
    """One row per period, or a reason when the document is unusable."""
    doc = F.from_xml(F.col(xml_col), schemas.LOAD_DOCUMENT, XML_OPTIONS)
    keep = [c for c in landed.columns if c != xml_col]
    # generator boundary: later filters on the document cannot inline (and
    # so repeat) the XML parse
    parsed = landed.select(*keep, F.col(xml_col).alias("raw"), F.explode(F.array(doc)).alias("_doc"))
    empty = F.col("raw").isNull() | (F.trim(F.col("raw")) == "")
    reason = (F.when(empty, F.lit("empty_payload"))
              .when(F.col("_doc").isNull() | F.col("_doc.TimeSeries").isNull(), F.lit("malformed_xml")))
    return parsed.withColumn("doc_reason", reason)


def period_columns(p) -> list:
    """Normalised columns of one ``Period`` struct."""
    res = F.coalesce(p["resolution"], F.lit("PT60M"))
    over = F.exists(p["Point"], lambda x: F.coalesce(over_limit(x["quantity"]), F.lit(False)))
    return [p["timeInterval"]["start"].alias("start_text"),
            parse_iso(p["timeInterval"]["start"]).alias("start"),
            res.alias("resolution"), points_per_hour(res).alias("points_per_hour"),
            F.coalesce(resolution_reason(res), F.when(over, F.lit("quantity_over_limit"))).alias("period_reason"),
            p["Point"].alias("points")]


def periods(parsed: DataFrame) -> DataFrame:
    """Explode series and periods, keeping their document order."""
    keep = [c for c in parsed.columns if c not in ("raw", "_doc", "doc_reason")]
    series = parsed.where(F.col("doc_reason").isNull()).select(
        *keep, F.posexplode("_doc.TimeSeries").alias("series_pos", "_series"))
    per = series.select(*keep, "series_pos", F.posexplode("_series.Period").alias("period_pos", "_p"))
    return per.select(*keep, "series_pos", "period_pos", *period_columns(F.col("_p")))


def periods_from_rows(rows: DataFrame) -> DataFrame:
    """Periods read one per row (XML source with ``rowTag=Period``)."""
    keep = [c for c in rows.columns if c not in schemas.LOAD_PERIOD.fieldNames()]
    return rows.select(*keep, *period_columns(F.struct(*[F.col(c) for c in schemas.LOAD_PERIOD.fieldNames()])))


def load_records_from_files(spark, root: str, by_position: bool = False) -> DataFrame:
    """A7 on raw documents: ``root/country=../city_name=../*.xml`` -> hourly load."""
    from gridlake.sources.payloads import read_load_xml_files
    hourly = hourly_from_periods(periods_from_rows(read_load_xml_files(spark, root)), by_position)
    return hourly.select("city_name", "country", "time", "load_mw")


def hourly_from_periods(per: DataFrame, by_position: bool = False) -> DataFrame:
    """Hourly mean per full block of points, linear in the points.

    The numeric values of a period are projected once, behind a generator
    boundary, so no filter or cast is repeated per block.
    """
    n = F.col("points_per_hour")
    usable = per.where(F.col("start").isNotNull() & n.isNotNull() & F.col("period_reason").isNull())
    point = F.transform("points", lambda p: F.struct(
        (p["position"].try_cast("bigint") if by_position else F.lit(None).cast("bigint")).alias("position"),
        exact(measure(p["quantity"])).alias("value")))
    good = F.filter(point, lambda p: p["value"].isNotNull())
    if by_position:
        good = F.array_sort(F.filter(good, lambda p: p["position"] >= 1))
    keep = [c for c in per.columns if c not in ("points", "start_text", "period_reason")]
    flat = usable.select(*keep, F.explode(F.array(good)).alias("_good")) \
        .withColumn("_values", F.transform("_good", lambda p: p["value"]))
    if by_position:
        # points in order of position; a block is full when exactly n of them fall into it
        flat = flat.withColumn("_slots", F.transform("_good", lambda p: F.call_function("div", p["position"] - 1, n)))
        slot = F.col("_slots")
        firsts = F.filter(
            F.sequence(F.lit(0), F.size("_values") - 1),
            lambda i: ((i == 0) | (F.get(slot, i - 1) != F.get(slot, i)))
            & (F.get(slot, i + n - 1) == F.get(slot, i))
            & F.coalesce(F.get(slot, i + n) != F.get(slot, i), F.lit(True)))
        spots = F.transform(firsts, lambda i: F.struct(F.get(slot, i).cast("int").alias("block"), i.alias("at")))
    else:
        spots = F.transform(F.sequence(F.lit(0), F.call_function("div", F.size("_values"), n).cast("int") - 1),
                            lambda b: F.struct(b.alias("block"), (b * n).alias("at")))
    spots = F.when(F.size("_values") >= n, spots)
    blocks = F.transform(spots, lambda s: F.struct(
        s["block"].alias("block"),
        F.aggregate(F.slice("_values", s["at"] + 1, n), F.lit(0).cast(TOTAL_DECIMAL),
                    lambda acc, v: (acc + v).cast(TOTAL_DECIMAL)).alias("total")))
    out = flat.select(*keep, F.inline(blocks))
    return out.select(*keep, "block", (F.col("start") + F.make_interval(hours=F.col("block"))).alias("time"),
                      half_up_mean(F.col("total"), n).alias("load_mw"))


def load_records(landed: DataFrame, by_position: bool = False) -> DataFrame:
    """Landed ``(country, city_name, xml)`` -> ``city_name, country, time, load_mw``."""
    hourly = hourly_from_periods(periods(parse_documents(landed)), by_position)
    return hourly.select("city_name", "country", "time", "load_mw")


def rejected_periods(per: DataFrame, source: str = "energy") -> DataFrame:
    """Quarantine rows of the periods that give no hours."""
    bad = per.where(F.col("period_reason").isNotNull() | F.col("start").isNull())
    return bad.select(
        F.lit(source).alias("source"),
        F.concat_ws("|", F.col("country"), F.col("start_text"), F.col("resolution")).alias("raw"),
        F.coalesce(F.col("period_reason"), F.lit("period_without_start")).alias("reason"),
        F.to_date("start").alias("event_date"), file_origin(per))


def rejected_from_parsed(parsed: DataFrame, source: str = "energy") -> DataFrame:
    """Quarantine rows for unusable documents and periods (B6, B15, Q13),
    from the output of ``parse_documents``."""
    docs = parsed.where(F.col("doc_reason").isNotNull()).select(
        F.lit(source).alias("source"), "raw", F.col("doc_reason").alias("reason"),
        F.lit(None).cast("date").alias("event_date"), file_origin(parsed))
    return docs.unionByName(rejected_periods(periods(parsed), source))


def rejected_documents(landed: DataFrame, source: str = "energy") -> DataFrame:
    """Quarantine rows for unusable documents and periods of landed rows."""
    return rejected_from_parsed(parse_documents(landed), source)
