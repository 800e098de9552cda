import os

import pytest
from helpers import plan

from postlark.plans import tables

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", sorted(tables.SCHEMAS))
def test_declared_columns_are_those_of_the_files(spark, name):
    stored = dict(spark.read.parquet(f"{SF_DIR}/{name}.parquet").dtypes)
    declared = dict(tables.table(spark, SF_DIR, name).dtypes)
    assert declared.items() <= stored.items()


def test_posts_hold_the_named_fields_only(spark):
    posts = tables.stream_posts(spark, SF_DIR, "author_id", "public_metrics")
    assert posts.select("data.*").columns == ["author_id", "public_metrics"]
    assert "text" not in plan(posts)
