"""Time stamps written in many ways."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats tried in this order.
FORMATS = ["yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]", "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]", "yyyy-MM-dd", "dd.MM.yyyy HH:mm", "dd/MM/yyyy HH:mm", "MM/dd/yyyy"]


def parsed(text: Column) -> Column:
    """The first format that fits, as a time stamp in UTC; null if none does.

    RFC 2822 dates lose their day name; zones other than a numeric offset, Z and GMT
    are not read.
    """
    t = F.trim(text)
    plain = F.regexp_replace(F.regexp_replace(t, "Z$", "+00:00"), r"^[A-Z][a-z]{2}, ", "")
    tries = [F.try_to_timestamp(plain, F.lit(f)) for f in FORMATS]
    rfc = F.try_to_timestamp(F.regexp_replace(plain, r" (GMT|UTC|\+0000)$", ""), F.lit("d MMM yyyy HH:mm:ss"))
    epoch = F.when(t.rlike("^[0-9]{10}$"), F.timestamp_seconds(t.try_cast("bigint"))).when(t.rlike("^[0-9]{13}$"), F.timestamp_millis(t.try_cast("bigint")))
    return F.coalesce(*tries, rfc, epoch)
