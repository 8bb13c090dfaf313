from rillflow.session import PARTITION_BYTES, size_settings


def test_partitions_follow_the_input_size():
    assert size_settings(1)["spark.sql.shuffle.partitions"] == "1"
    assert size_settings(10 * PARTITION_BYTES)["spark.sql.shuffle.partitions"] == "10"
    hundred_tb = size_settings(100 * 10**12)
    assert 300_000 < int(hundred_tb["spark.sql.shuffle.partitions"]) < 500_000
    assert hundred_tb["spark.sql.files.maxPartitionBytes"] == str(PARTITION_BYTES)
