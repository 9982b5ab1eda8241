import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tripforge.session import build_session
    s = build_session("local[4]", app_name="tripforge-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sample(spark):
    """The 20-row shipped catalogue inputs (with places + costs + profile)."""
    from pyspark.sql import types as T
    from tripforge.sources.catalog_io import read_catalog
    d, s, i, b = T.DoubleType(), T.StringType(), T.IntegerType(), T.LongType()
    fields = [("destination_name", s), ("country", s), ("destination_type", s), ("latitude", d), ("longitude", d)]
    for season in ["winter", "spring", "summer", "autumn"]:
        fields += [(f"{season}_avg_temp", d), (f"{season}_avg_daily_rain", d)]
    fields += [("search_radius_m", i)] + [(c, b) for c in ["restaurant_count", "cafe_count", "bar_count",
                                                          "museum_count", "park_count", "nearby_beach_count"]]
    fields += [("cost_of_living_index", d), ("cluster_profile", s), ("expected_climate", s),
               ("expected_style", s), ("expected_city", s), ("expected_overall", d), ("expected_std", d),
               ("expected_cost_level", s)]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    return read_catalog(spark, os.path.join(FIXTURES, "destinations_sample.csv"), schema).cache()
