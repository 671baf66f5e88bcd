"""The adapter keeps every fact row."""

import os

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from salescast.sources import starschema

pytestmark = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="driver tables are not here")


def test_no_unit_and_no_day_is_lost(spark):
    facts = starschema.table(spark, TESTDATA, "lineitem").agg(
        F.sum("l_quantity"), F.min(F.to_date("l_shipdate")), F.max(F.to_date("l_shipdate"))).first()
    daily = starschema.daily_sales(spark, TESTDATA).cache()
    sales = starschema.sales_long(daily).agg(F.sum("sales"), F.min("d"), F.max("d")).first()
    days = (facts[2] - facts[1]).days + 1
    assert tuple(sales) == (facts[0], 1, days)
    assert starschema.calendar(daily).count() == days
