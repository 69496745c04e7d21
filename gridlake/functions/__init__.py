"""Column-level helpers: every function returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen."""

from gridlake.functions.numeric import (dec2, exact, exact_sum, exact_total, half_up_mean, half_up_mean_of,
                                        mean_and_sd_from_sums, measure)
from gridlake.functions.resolution import points_per_hour, resolution_reason
from gridlake.functions.timefmt import (compact_stamp, date_key, iso_offset, parse_iso,
                                        period_start, utc_wall_clock)

__all__ = [
    "dec2", "exact", "exact_sum", "exact_total", "half_up_mean", "half_up_mean_of", "mean_and_sd_from_sums", "measure",
    "points_per_hour", "resolution_reason",
    "compact_stamp", "date_key", "iso_offset", "parse_iso", "period_start", "utc_wall_clock",
]
