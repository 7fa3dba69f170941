import pytest

from stellate.plans.serve import entity_lookup, price_by_region


@pytest.fixture()
def schools(spark):
    return spark.createDataFrame([("St Mary's", 1), ("' OR '1'='1", 2), ("Other", 3)], "school_name string, n int")


def test_lookup_quotes_and_injection(spark, schools):
    assert [r["n"] for r in entity_lookup(spark, schools, "St Mary's").collect()] == [1]
    assert [r["n"] for r in entity_lookup(spark, schools, "' OR '1'='1").collect()] == [2]
    assert entity_lookup(spark, schools, "missing").count() == 0
    with pytest.raises(ValueError):
        entity_lookup(spark, schools, "")


def test_price_series(spark):
    hp = spark.createDataFrame([(10, "2020", 5), (10, "2019", 4), (11, "2020", 9)],
                               "local_government_code int, year string, median_house_price int")
    sc = spark.createDataFrame([(10, "A"), (10, "A"), (11, "B")], "local_government_code int, local_government string")
    out = [tuple(r) for r in price_by_region(spark, hp, sc, 10).collect()]
    assert out == [(10, "A", 4, "2019"), (10, "A", 5, "2020")]
