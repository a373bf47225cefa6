import pytest

from verbalance import session


class Unset:
    """A session whose cluster names no shared folder."""

    def __init__(self, master):
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})
        self.sparkContext = type(
            "Context",
            (),
            {
                "master": master,
                "folder": None,
                "getCheckpointDir": lambda c: c.folder,
                "setCheckpointDir": lambda c, folder: setattr(c, "folder", folder),
            },
        )()


def test_the_named_folder_is_used(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    first, second = (session.scratch_path(spark, "x") for _ in range(2))
    assert first != second and first.startswith(session.shared_folder(spark))


@pytest.mark.parametrize("master", ["local", "local[4]"])
def test_a_local_session_gets_a_folder(master):
    unset = Unset(master)
    assert session.shared_folder(unset) == session.shared_folder(unset)


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "yarn", "spark://host:7077"])
def test_a_cluster_must_name_one(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Unset(master))


def test_spread_leaves_tables_with_enough_splits_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, cores)
    assert session.spread(many, "id") is many
    assert session.spread(spark.range(0, 100, 1, 1), "id").rdd.getNumPartitions() == cores


def test_written_table_is_read_back(spark, tmp_path):
    frame = spark.range(5).withColumnRenamed("id", "n")
    again = session.written(frame, str(tmp_path / "t"))
    assert again.columns == ["n"] and again.count() == 5
    assert "FileScan parquet" in again._jdf.queryExecution().toString()


def test_shuffle_partitions_follow_the_size(spark, tmp_path):
    key = "spark.sql.shuffle.partitions"
    configured = spark.conf.get(key)
    with session.shuffles_for(spark, 10 * session.BYTES_PER_SHUFFLE_PARTITION + 1):
        assert spark.conf.get(key) == "11"
    with session.shuffles_for(spark, 1):
        assert spark.conf.get(key) == configured
    assert spark.conf.get(key) == configured
    path = str(tmp_path / "t")
    session.written(spark.range(1000), path)
    on_disk = sum(f.stat().st_size for f in (tmp_path / "t").glob("part-*"))
    assert session.stored_bytes(spark, path) == on_disk
