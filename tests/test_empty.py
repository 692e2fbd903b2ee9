"""No query of the session operators fails on empty tables; those that count say 0."""

import pytest

from sessionlake.plans import QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "customer supplier part orders lineitem events documents conversations labels pages benchmark".split()
#: One row of totals, whatever there is.
TOTALS = {"tree_files", "curation_metrics", "rollout_metrics", "duplicate_lines", "set_digest", "inventory_errors"}
#: Reads files that the adapter writes one a row: without rows there is no path.
FILES = {"trial_results"}


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for t in TABLES:
        spark.read.parquet(f"{DATA}/{t}.parquet").limit(0).coalesce(1).write.parquet(f"{folder}/{t}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FILES))
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == (1 if name in TOTALS else 0)
