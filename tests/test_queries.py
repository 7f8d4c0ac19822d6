"""Every registered query against its SQL, or for a non-empty result where it has none."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from tests.compare import difference, duck
from tidegauge.operators import features
from tidegauge.plans import catalog

# Minutes of training each; their parts are tested in test_ml.py and test_forest.py.
LONG_TRAINING = {"rf_regression", "cv_grid"}
UNSTATED = sorted(set(catalog.QUERIES) - set(catalog.ORACLES) - LONG_TRAINING)
#: Queries at a time: on small tables most of a query's time is planning, on one core.
AT_A_TIME = 3
#: In place of thousands of window pairs; test_ml.py checks that the whole grid is asked for.
FEW_PAIRS = {"short": (range(1, 4), range(3, 6)), "medium": (range(1, 4), range(20, 22)), "long": (range(1, 4), range(40, 42))}


@pytest.fixture(scope="module")
def outcomes(spark, sf_dir):
    """The outcome of each query with SQL as a future; they run in the background."""

    def compared(name):
        with duck(sf_dir) as con:
            return difference(spark, con, sf_dir, catalog.QUERIES[name], catalog.ORACLES[name])[0]

    with ThreadPoolExecutor(AT_A_TIME) as pool:
        yield {name: pool.submit(compared, name) for name in sorted(catalog.ORACLES)}
        pool.shutdown(cancel_futures=True)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_equals_sql(outcomes, name):
    assert outcomes[name].result() is None


@pytest.mark.parametrize("name", UNSTATED)
def test_gives_rows(spark, sf_dir, monkeypatch, name):
    """Mostly training, which uses all cores and is not run side by side."""
    monkeypatch.setattr(features, "HORIZONS", FEW_PAIRS)
    assert catalog.QUERIES[name](spark, sf_dir).take(1)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).take(1)
    assert set(entry.oracle_sql()) <= set(entry.queries())
