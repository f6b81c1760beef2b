from cellwise.session import ensure_checkpoint_dir, scale_conf, scratch_path


def test_checkpoint_dir_is_kept_and_scratch_is_under_it(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and ensure_checkpoint_dir(spark) == d  # an existing setting is never replaced
    p = scratch_path(spark, "x")
    assert p.startswith(d.rstrip("/")) and p != scratch_path(spark, "x")


def test_scale_conf_sizes_partitions():
    c = scale_conf(100 * 2 ** 40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    small = scale_conf(10 * 2 ** 20, 64)
    assert int(small["spark.sql.shuffle.partitions"]) == 128  # at least two waves of cores
    assert c["spark.sql.adaptive.enabled"] == "true"
