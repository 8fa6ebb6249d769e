import datetime as dt
from collections import Counter

import pytest
from plans import executed_plan, full_plan, scans

import __spark_entry__ as registry
from tradewind.functions import register_sql_functions
from tradewind.operators import grid_pyramid


def test_every_level_counts_the_points(spark):
    points = [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (-0.001, -0.001), (95.0, 10.0), (None, 1.0), (1.0, None), (float("nan"), 1.0)]
    points += [(10.0 + i % 3, 20.0) for i in range(300)]
    df = spark.createDataFrame(points, "lat double, lng double").repartition(3)
    found = {(r.level, r.y, r.x): r.points for r in grid_pyramid(df, "lat", "lng", 3).collect()}
    want = Counter()
    for lat, lng in points:
        if lat is not None and lng is not None and lat == lat:
            for level in range(4):
                n = 1 << level
                want[level, min(int((lat + 90) / 180 * n), n - 1), min(int((lng + 180) / 360 * n), n - 1)] += 1
    assert found == want and found[0, 0, 0] == 305
    assert grid_pyramid(df.limit(0), "lat", "lng").count() == 0


def test_points_are_read_once(spark):
    plan = executed_plan(registry.queries()["map_cells"](spark, "/root/testdata/sf0.001"))
    assert scans(plan) == {"customer": 1}


def test_functions_in_sql(spark):
    register_sql_functions(spark)
    row = spark.sql(
        "SELECT tw_band(9.0, array(8.0, 4.0)) AS a, tw_band(8.0, array(8.0, 4.0)) AS b, tw_band(1.0, array(8.0, 4.0)) AS c, "
        "tw_band(NULL, array(8.0)) AS d, tw_pick(1, array('x', 'y')) AS e, tw_cents(1.1) AS f, tw_cents(-0.29) AS g, "
        "tw_cents(NULL) AS h, tw_month_start(DATE '2020-02-29') AS i, tw_month_label(3) AS j"
    ).first()
    assert tuple(row) == (0, 1, 2, None, "y", 110, -29, None, dt.date(2020, 2, 1), "Mar")
    months = spark.sql("SELECT * FROM tw_months(DATE '2019-11-30', DATE '2020-01-01')").collect()
    assert [r.month for r in months] == [dt.date(2019, 11, 1), dt.date(2019, 12, 1), dt.date(2020, 1, 1)]
    with pytest.raises(Exception, match="whole cents"):
        spark.sql("SELECT tw_cents(1.234) AS x").collect()


def test_plans_hold_plain_expressions(spark):
    plan = full_plan(registry.queries()["sql_state_bands"](spark, "/root/testdata/sf0.001"))
    assert "UDF" not in plan and "tw_" not in plan and "Python" not in plan
