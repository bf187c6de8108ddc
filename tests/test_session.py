"""Session utilities: the shared scratch folder, staging."""

from portolan.session import checkpoint_root, scratch_path, stage


def test_scratch_and_stage_live_under_the_checkpoint_folder(spark):
    root = checkpoint_root(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or root == configured.rstrip("/")
    path = scratch_path(spark, "x")
    assert path.startswith(root) and path != scratch_path(spark, "x")
    staged = stage(spark.range(5), "five")
    assert staged.count() == 5 and staged.inputFiles()[0].find(root.split(":")[-1]) >= 0


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _ConnectLike:
    """A session without a SparkContext and without spark.checkpoint.dir."""

    def __init__(self, master):
        self.conf = _Conf({"spark.master": master, "spark.app.id": f"stub-{master}"})

    @property
    def sparkContext(self):
        raise RuntimeError("no SparkContext")


def test_checkpoint_root_when_unset():
    import pytest
    local = _ConnectLike("local[2]")
    first = checkpoint_root(local)
    assert first == checkpoint_root(local)  # one folder per application
    with pytest.raises(RuntimeError):
        checkpoint_root(_ConnectLike("yarn"))
