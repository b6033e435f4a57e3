from datetime import datetime, timezone
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tidemark.functions import (
    clock_text,
    date_key,
    decode_path,
    name_from_path,
    row_hash,
    safe_name,
    split_location,
    split_typed,
    wall_time_text,
)


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_row_hash_joins_text_and_skips_nulls(spark):
    a, null, b = F.lit("a"), F.lit(None).cast("string"), F.lit(7)
    row = one(spark, row_hash([a, null, b]), row_hash([a, b]), row_hash([a, null, b], "~"))
    assert row[0] == row[1] == sha256(b"a||7").hexdigest()
    assert row[2] == sha256(b"a||~||7").hexdigest()


def test_names_and_paths(spark):
    row = one(
        spark,
        safe_name(F.lit("Jersey: Airport (A-1)")),
        name_from_path(F.lit("gs://b/x/Jersey__Airport.json")),
        name_from_path(F.lit("gs://b/x/readme.txt")),
        decode_path(F.lit("file:/a%20b/c.json")),
    )
    assert tuple(row) == ("Jersey__Airport__A-1_", "Jersey__Airport", "", "file:/a b/c.json")


@pytest.mark.parametrize(
    "text, expected",
    [
        ("54.168, -4.48", (54.168, -4.48)),
        (" 1 ,\t2\n", (1.0, 2.0)),
        ("54.168", (54.168, None)),
        ("north, -4.48", (None, -4.48)),
        ("51.5d, 2f", (None, None)),
        ("1,2,3", (1.0, 2.0)),
        ("", (None, None)),
        (None, (None, None)),
    ],
)
def test_split_location(spark, text, expected):
    assert tuple(one(spark, *split_location(F.lit(text).cast("string")))) == expected


def test_day_key_and_clock_do_not_follow_the_host_zone(spark):
    text = F.lit("2024-01-15T23:30:00Z")
    assert tuple(one(spark, date_key(text), clock_text(text))) == (20240115, "23:30:00")
    bad = F.lit("at noon")
    assert tuple(one(spark, date_key(bad), clock_text(bad))) == (None, None)


@pytest.mark.parametrize(
    "moment, zone, expected",
    [
        ("2024-07-01T12:00:00Z", "Europe/London", "2024-07-01T13:00:00+01:00"),
        ("2024-01-01T12:00:00Z", "Europe/London", "2024-01-01T12:00:00Z"),
        ("2024-01-01T12:00:00Z", "America/St_Johns", "2024-01-01T08:30:00-03:30"),
    ],
)
def test_wall_time_names_the_offset_of_its_zone(spark, moment, zone, expected):
    assert one(spark, wall_time_text(F.lit(moment), zone))[0] == expected
    utc = datetime.fromisoformat(expected).astimezone(timezone.utc)
    assert utc == datetime.fromisoformat(moment)


TEXTS = (
    "1 1.5 -2 +3 .5 5. 1e3 1E-4 -1.5e+7 0x1p3 1d 2.5F NaN nan Infinity -inf +INF inf "
    "SW N NE A - + . 1,5 1_000 e5 0x infinite nano 12abc 1e --1 1.2.3 ٣"
).split() + [" 5 ", "\t7\n", "", " ", "1 2"]


def test_split_typed_equals_the_plain_cast(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS] + [(None,)], "raw string")
    number, text = split_typed("raw")
    plain = F.col("raw").try_cast("double")
    rows = df.select("raw", number.alias("n"), text.alias("t"), plain.alias("p")).collect()
    for row in rows:
        assert str(row.n) == str(row.p), row
        assert row.t == (row.raw if row.p is None else None), row
