import pytest

from tidemark.session import CHECKPOINT_DIR, HASH_PACKING, hashes_packed, pin_utc, scratch_dir


class Fake:
    """A session as far as the choice of a folder needs one."""

    def __init__(self, setting, master):
        self.conf = {CHECKPOINT_DIR: setting}
        self.sparkContext = self
        self.master = master


def test_scratch_lies_in_the_shared_folder_the_cluster_names():
    spark = Fake("gs://shared/checkpoints/", "yarn")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith("gs://shared/checkpoints/tidemark/x-")
    assert first != second


def test_only_local_sessions_fall_back_to_this_machine():
    assert "tidemark/x-" in scratch_dir(Fake(None, "local[2]"), "x")
    with pytest.raises(RuntimeError):
        scratch_dir(Fake(None, "yarn"), "x")


def test_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    pin_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_hashes_are_packed_within_a_block_unless_the_session_names_how(spark):
    def seen():
        return [spark.conf.get(key, None) for key in HASH_PACKING]

    version, level = HASH_PACKING
    with hashes_packed(spark):
        assert seen() == list(HASH_PACKING.values())
    assert seen() == [None, None]
    spark.conf.set(version, "PARQUET_1_0")
    try:
        with hashes_packed(spark):
            assert seen() == ["PARQUET_1_0", HASH_PACKING[level]]
        assert seen() == ["PARQUET_1_0", None]
    finally:
        spark.conf.unset(version)
    # what the cluster names in its Hadoop settings
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set(level, "9")
    try:
        with hashes_packed(spark):
            assert seen() == [HASH_PACKING[version], None]
    finally:
        hadoop.unset(level)
