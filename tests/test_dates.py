from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates as D

VALUES = [
    "Tue, 02 Jan 2024 03:04:05 GMT", "Mon, 02 Jan 2024 03:04:05 utc", "2024-01-02T03:04:05+01:00",
    "2024-01-02T03:04:05+0100", "2024-01-02T03:04:05Z", "2024-01-02T03:04:05z", "2024-01-02T03:04:05",
    "2024-01-02 03:04:05", "2024-1-2", "2024-01-02T03:04:05.123456", "Tue, 02 Jan 2024 03:04:05 +0000",
    "2024-02-30", "0000-01-01", "2024-01-02t3:4:5", "Tue,  2  jAN 2024 3:4:5 GMT", "2024-01-02 03:04:60",
    "x", "", "2024-01-02T03:04:05-23:59", "2024-01-02T03:04:05+24:00", " 2024-01-02", "2024-01-02\n",
    "31 Feb 2024", "2023-02-29", "2024-02-29", "9999-12-31",
]


def by_strptime(value, formats):
    for fmt in formats:
        try:
            parsed = datetime.strptime(value, fmt)
        except ValueError:
            continue
        utc = parsed.astimezone(timezone.utc) if parsed.tzinfo else parsed
        return utc.replace(tzinfo=None), fmt
    return None


@pytest.mark.parametrize("formats", [D.COMPAT_FORMATS, D.DEFAULT_FORMATS])
def test_parse_published_equals_strptime(column, formats):
    found = column(VALUES, lambda c: D.parse_published(c, formats))
    assert [r and (r.ts, r.fmt) for r in found] == [by_strptime(v, formats) for v in VALUES]


def test_null_is_not_a_date(column):
    assert column([None], D.parse_published) == [None]


def test_parse_date(column):
    values = ["1/2/2003", "01/02/2003", "31/02/2001", "25/12/2001", "01/02/2003x", "1/2/03", None]
    found = column(values, lambda c: D.iso_date(D.parse_date(c)))
    assert found == ["2003-02-01", "2003-02-01", None, "2001-12-25", None, None, None]
    iso = column(["2003-02-01", "2003-2-1"], lambda c: D.iso_date(D.parse_date(c, "yyyy-MM-dd")))
    assert iso == ["2003-02-01", None]
    with pytest.raises(ValueError):
        D.parse_date(None, "yyyy")


def test_whole_days(spark):
    sql = "select timestamp'2024-01-01 23:00:00' a, timestamp'2024-01-02 22:00:00' b, timestamp'2024-01-02 23:00:00' c"
    row = spark.sql(sql).select(D.whole_days(F.col("a"), F.col("b")), D.whole_days(F.col("a"), F.col("c"))).first()
    assert tuple(row) == (0, 1)
