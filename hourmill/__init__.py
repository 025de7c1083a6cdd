"""hourmill: a Spark-native medallion pipeline for hourly time series.

Raw JSON snapshots (bronze) are unnested into rows, cleaned, keyed and
upserted into date-partitioned tables (silver); a price series is joined
with environmental series, given a trailing time-range average and a
CHEAP/NORMAL label (gold), and served as tables and grouped aggregates.

Everything is expressed with the DataFrame API so that Catalyst plans it
and the cluster executes it; the driver only holds configuration and a
handful of scalars (a high-water mark, a list of touched dates).
"""

from hourmill.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
