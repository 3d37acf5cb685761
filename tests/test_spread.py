"""Rows of small files are dealt over tasks before heavy work."""

import pytest

from prospectra.plans import catalog, pages

from .conftest import SF


@pytest.mark.parametrize("name", ["site_mailboxes", "mailbox_people", "place_attributes", "directory_venues", "document_texts"])
def test_no_task_has_all_pages(spark, name):
    """F6, F10, F12 and those that share the step: a file of one row group was one task's, pages and all."""
    query = {**catalog.QUERIES, **pages.QUERIES}[name]
    assert query(spark, SF).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_sites_are_spread(spark):
    """What these read."""
    assert catalog.sites(spark, SF).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
