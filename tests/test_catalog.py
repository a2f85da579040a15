import __spark_entry__ as contract


def test_daily_moving_average_is_registered_over_all_months(spark):
    queries = contract.queries()
    whole, gaps = (queries[n](spark, contract.SMOKE_DIR).collect() for n in ("w08_daily_moving_average_all_months", "w08_daily_moving_average"))
    assert "w08_daily_moving_average_all_months" in contract.oracle_sql()
    assert sorted(map(tuple, whole)) != sorted(map(tuple, gaps)) and len({r["day"] for r in whole}) == len(whole) > 0
