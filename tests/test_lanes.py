from pathlib import Path

import pytest

from lanes import queries
from peakloom.schema import EXPORT_HEADER
from peakloom.sources.export import QUOTED

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


def test_export_files_take_little_room(spark, tmp_path):
    path = queries._written_export(spark, SF_DIR, "room").removeprefix("file:")
    text = queries.export_text(spark, SF_DIR)
    text.write.option("header", True).options(**QUOTED).csv(str(tmp_path / "plain"))
    size = lambda folder: sum(f.stat().st_size for f in Path(folder).glob("part-*"))
    assert size(path) < 0.3 * size(tmp_path / "plain")
    read = lambda folder: sorted(map(tuple, spark.read.option("header", True).options(**QUOTED).csv(str(folder)).collect()))
    assert read(path) == read(tmp_path / "plain")
    assert spark.read.option("header", True).options(**QUOTED).csv(path).columns == EXPORT_HEADER


def test_traces_that_are_read_once_are_not_written(spark, monkeypatch):
    def stored(*_):
        raise AssertionError("the export is written")
    monkeypatch.setattr(queries.tb, "stored_export", stored)
    assert queries.similarity_traces(spark, SF_DIR).count() > 0
