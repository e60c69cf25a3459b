import os

import pyarrow as pa
import pytest

from lodestrata.llm import common as c


def test_released_tables(spark, scratch):
    earlier = c.stored(spark.range(3), "earlier")
    before = c.made()
    one = c.stored(spark.range(5), "one")
    two = c.stored(spark.range(7), "two")
    folders = [f.removeprefix("file://").rpartition("/")[0] for df in (one, two) for f in df.inputFiles()[:1]]
    c.release(spark, before, [two])
    assert [os.path.isdir(f) for f in folders] == [False, True]
    assert two.count() == 7
    c.release(spark, before)
    assert not os.path.isdir(folders[1]) and earlier.count() == 3


def test_new_columns_replace_kept_ones(spark):
    rows = spark.createDataFrame([(1, "ab", "x")], "id long, text string, SIZE string")
    found = c.map_texts(rows, "text", [("size", pa.int64())], lambda: lambda texts: [[len(t) for t in texts]])
    assert found.columns == ["id", "text", "size"] and [tuple(r) for r in found.collect()] == [(1, "ab", 2)]


def test_two_generations():
    kept = c.Kept(2)
    for k in "abc":
        kept.put(k, k)
    assert kept.young == {"c": "c"} and kept.older("a") == "a" and kept.older("z") is None
    kept.put("d", "d")
    assert "a" in kept.old and "b" not in kept.old and kept.young == {"d": "d"}


def test_a_cluster_must_name_the_folder(spark, monkeypatch):
    class Other:
        class conf:
            get = staticmethod(lambda key, otherwise: None)

        class sparkContext:
            master = "yarn"

            class _jsc:
                class sc:
                    @staticmethod
                    def getCheckpointDir():
                        class none:
                            isDefined = staticmethod(lambda: False)

                        return none

    with pytest.raises(ValueError):
        c.shared_folder(Other)
