"""One-pass grouped states against plain Python, and the plans of the models built on them."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import listing_row, raw_listings_df
from stratum.operators.lookup import city_dimension
from stratum.operators.states import grouped_states
from stratum.plans.bronze import bronze_listings
from stratum.plans.gold import fct_price_vs_rating, fct_revenue_by_city, fct_superhost_performance
from stratum.plans.silver import silver_listings


def test_states_match_plain_python_with_null_keys_and_ids(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice(["hot", "hot", "b", None]), rnd.choice([None, 1, 2, 3, 4]), rnd.choice([None, 10, 20]),
             rnd.choice([None, 1.5, 2.0, 2.0, 9.25]), rnd.choice([None, True, False]), rnd.choice([None, 3, 7]))
            for _ in range(400)] + [("empty", None, None, None, None, None)]
    df = spark.createDataFrame(rows, "k string, a long, b long, v double, t boolean, m long")
    got = grouped_states(df, ["k"], "v", {"avg_m": F.col("m")}, {"true_rows": F.col("t")},
                         {"a": {"as": None, "true_as": F.col("t"), "big_as": F.col("m") > 5}, "b": {"bs": None}}).collect()
    assert len(got) == 4
    for r in got:
        mine = [x for x in rows if x[0] == r.k]
        values = [x[3] for x in mine if x[3] is not None]
        measured = [x[5] for x in mine if x[5] is not None]
        assert r.rows == len(mine) and r.true_rows == sum(x[4] is True for x in mine)
        assert r["median"] == (statistics.median(values) if values else None)
        assert (r.low, r.high) == ((min(values), max(values)) if values else (None, None))
        assert r.avg_m == (pytest.approx(sum(measured) / len(measured)) if measured else None)
        assert r["as"] == len({x[1] for x in mine} - {None}) and r.bs == len({x[2] for x in mine} - {None})
        assert r.true_as == len({x[1] for x in mine if x[4]} - {None})
        assert r.big_as == len({x[1] for x in mine if x[5] and x[5] > 5} - {None})
    assert grouped_states(df.limit(0), ["k"], "v", {}, {}, {"a": {"as": None}}).count() == 0


@pytest.mark.parametrize("model", [fct_revenue_by_city, fct_superhost_performance, fct_price_vs_rating])
def test_models_read_silver_once(spark, scratch, model):
    rows = [listing_row(listing_id=str(i), price=str(20 + i)) for i in range(1, 40)]
    bronze_listings(raw_listings_df(spark, rows)).write.parquet(f"{scratch}/bronze")
    s = silver_listings(spark.read.parquet(f"{scratch}/bronze"), city_dimension(spark), "2024-01-01")
    plan = model(s, order=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1, plan
    assert "Expand" not in plan and "SortMergeJoin" not in plan
