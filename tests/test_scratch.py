"""Scratch folders are removed by age, and nothing else below the checkpoint folder."""

import os

from hourglass import session


class _At:
    """A session whose checkpoint folder is another one."""

    def __init__(self, spark, root):
        self._jvm, self._jsc, self.sparkContext = spark._jvm, spark._jsc, spark.sparkContext
        self.conf = type("Conf", (), {"get": lambda _, key, default=None: root})()


def test_only_old_scratch_goes(spark, tmp_path):
    at = _At(spark, str(tmp_path))
    made = [session.scratch_path(at, label) for label in ("near", "a-b")]
    for path in (*made, str(tmp_path / "mine"), str(tmp_path / "hourglass-ckpt")):
        os.makedirs(path)
    assert session.clear_scratch(at, older_than_hours=1) == []
    assert sorted(session.clear_scratch(at, older_than_hours=0)) == sorted(os.path.basename(p) for p in made)
    assert sorted(os.listdir(tmp_path)) == ["hourglass-ckpt", "mine"]
    assert session.clear_scratch(_At(spark, str(tmp_path / "none")), 0) == []
