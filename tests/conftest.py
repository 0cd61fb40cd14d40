import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).parent.parent))

from strata import Site  # noqa: E402
from strata.plans import config  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def bare_site(spark, tmp_path):
    """A site whose schemas do not exist yet."""
    unique = uuid.uuid4().hex[:10]
    layers = tuple(f"{name}_{unique}" for name in ("bronze", "silver", "gold"))
    return Site(admin=f"admin_{unique}", layers=layers, root=f"file:{tmp_path}/tables").on(spark)


@pytest.fixture
def site(spark, bare_site):
    config.install(spark, bare_site)
    return bare_site


@pytest.fixture
def bronze(site):
    return site.layers[0]


@pytest.fixture
def silver(site):
    return site.layers[1]


@pytest.fixture
def gold(site):
    return site.layers[2]


@pytest.fixture
def rows(spark):
    """Sorted plain tuples of a table or frame."""

    def read(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(row) for row in df.collect()), key=repr)

    return read
