from snapmart.session import MAX_SHUFFLE_PARTITIONS, shuffle_partitions_for, size_shuffles


def test_partitions_follow_the_input():
    assert shuffle_partitions_for(0, 8) == 8
    assert shuffle_partitions_for((20 << 30) + 1, 8) == 21
    assert shuffle_partitions_for(100 << 40, 4000) == MAX_SHUFFLE_PARTITIONS
    assert shuffle_partitions_for(1 << 40, 90_000) == 90_000


def test_a_higher_setting_stays(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 30 << 30) == 30
        assert size_shuffles(spark, 1) == 30
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
