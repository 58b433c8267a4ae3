import pytest

from millrace.session import delete_written, path_exists, scratch_dir, written


class FakeConf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.value or default


class FakeContext:
    def __init__(self, master, checkpoint=None):
        self.master, self.checkpoint = master, checkpoint

    def getCheckpointDir(self):
        return self.checkpoint


class FakeSession:
    def __init__(self, conf, context):
        self.conf, self.sparkContext = FakeConf(conf), context


def test_scratch_is_where_the_cluster_says():
    session = FakeSession("hdfs://shared/ck/", FakeContext("yarn"))
    first, second = scratch_dir(session, "x"), scratch_dir(session, "x")
    assert first.startswith("hdfs://shared/ck/x-") and first != second


def test_cluster_without_shared_scratch_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(FakeSession(None, FakeContext("yarn")), "x")


def test_written_table_equals_its_frame(spark):
    table = written(spark.range(5), "five")
    assert sorted(r.id for r in table.collect()) == [0, 1, 2, 3, 4]
    path = table.inputFiles()[0]
    assert path_exists(spark, path) and not path_exists(spark, path + ".none")


def test_tables_are_deleted_when_done(spark):
    folder = lambda table: table.inputFiles()[0].rpartition("/")[0]
    first, kept = written(spark.range(5), "first"), written(spark.range(3), "kept")
    paths = [folder(t) for t in (first, kept)]
    second = written(first.where("id > 2"), "second", done=[first, spark.range(1)])
    assert second.count() == 2 and not path_exists(spark, paths[0]) and path_exists(spark, paths[1])
    delete_written(spark, but_for=second)
    assert not path_exists(spark, paths[1]) and second.count() == 2
    there = folder(second)
    delete_written(spark)
    assert not path_exists(spark, there)
