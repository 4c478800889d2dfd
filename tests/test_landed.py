"""Landed pages: many a file, so that the files do not grow with the pages."""

import pytest

from tagflow import registry
from tagflow.tables import folders, shared_dir

SMALL = "/root/testdata/sf0.001"


def _lands(spark, label: str) -> set[str]:
    """The shared folders of a label."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{label}-*")
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place)
    return {s.getPath().toString() for s in found or ()}


@pytest.mark.parametrize(("name", "label"), [("landed_references", "entities"), ("landed_cells", "grids"), ("stream_pages", "landed"), ("landed_rules", "rules-pages"), ("landed_history", "history-pages"), ("landed_metadata", "metadata-pages")])
def test_landed_pages_share_files(spark, name, label):
    before = _lands(spark, label)
    registry.QUERIES[name](spark, SMALL)
    (folder,) = _lands(spark, label) - before
    pages, files = spark.read.text(folder), spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder)
    assert pages.count() > 20 and files.count() <= 4  # as many as there are tasks


def test_raw_files_lie_in_folders_that_tasks_list(spark):
    before = _lands(spark, "raw")
    registry.QUERIES["raw_manifest"](spark, SMALL)
    (root,) = {r for r in _lands(spark, "raw") - before if "/raw-plan" not in r}
    assert folders(spark, root) and spark.read.format("binaryFile").load(root).count() == 0
    assert spark.read.format("binaryFile").load(f"{root}/*").count() > 20
