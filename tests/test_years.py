"""Every year of the data is run, not a fixed list."""

from pyspark.sql import functions as F

from bellwether.plans import queries
from bellwether.sources import derive

DATA = "/root/testdata/sf0.001"


def test_cross_year_all_takes_its_years_from_the_data(spark):
    years = sorted(x[0] for x in derive.index_bars(spark, DATA).select(F.year("bar_date")).distinct().collect())
    assert len(years) > len(queries._YEARS)
    got = {(x["from_year"], x["to_year"]): x for x in queries.QUERIES["cross_year_all"](spark, DATA).collect()}
    assert sorted(got) == list(zip(years, years[1:]))
    fixed = queries.QUERIES["cross_year"](spark, DATA).collect()
    assert len(fixed) == 2 and all(got[x["from_year"], x["to_year"]] == x for x in fixed)
