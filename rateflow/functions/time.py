"""Calendar helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_of_epoch(ts: Column | str) -> Column:
    """UTC calendar year of epoch seconds.

    Computed from the epoch day rather than through a session-zone timestamp, so the
    result does not depend on ``spark.sql.session.timeZone``.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.year(F.date_from_unix_date(F.floor(ts / F.lit(86400)).cast("int")))
