import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from farpoint.session import build_session
    s = build_session("local[*]", shuffle_partitions=8)
    yield s
    s.stop()


def mall_rows(planted: bool = False):
    """The formula-made mall-style table (200 rows) from FIXTURES.md §1."""
    rows = []
    for i in range(200):
        genre = "Female" if i % 5 < 3 else "Male"
        age = 18 + (7 * i) % 50
        income = 15 + (13 * i) % 120
        score = 1 + (17 * i) % 99
        if planted and i == 50:
            score = 150
        if planted and i == 72:
            age = 150
        rows.append((i, genre, age, income, score))
    return rows


MALL_SCHEMA = "id int, Genre string, Age int, AnnualIncome int, SpendingScore int"
MALL_FEATURES = ["Genre", "Age", "AnnualIncome", "SpendingScore"]


@pytest.fixture(scope="session")
def mall(spark):
    clean = spark.createDataFrame(mall_rows(), MALL_SCHEMA).coalesce(1)
    planted = spark.createDataFrame(mall_rows(True), MALL_SCHEMA).coalesce(1)
    return clean, planted
