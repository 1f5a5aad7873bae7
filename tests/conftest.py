import os
import sys
import tempfile
from datetime import datetime, timedelta, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from seismerge.schemas import CANONICAL  # noqa: E402
from seismerge.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[*]", 8, driver_memory="8g")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="seismerge-test-"))
    yield s


T0 = datetime(2025, 1, 1, 12, 0, 0, tzinfo=timezone.utc)


def ev(source, t, lat, lon, mag=None, mag_type="ML", depth=10.0, place=None, province=None,
       district=None, event_id=None):
    """A canonical report."""
    return (source, event_id or f"{source}-{t.isoformat()}", t, float(lat), float(lon), depth,
            None if mag is None else float(mag), mag_type, place, province, district)


def reports_df(spark, rows):
    return spark.createDataFrame(rows, CANONICAL)


def secs(s):
    return timedelta(seconds=s)
