import pytest
from pyspark.sql import functions as F

from millrace.cli import main, parser


def test_producer_consumer_audit(spark, tmp_path, capsys):
    at = str(tmp_path)
    produce = f"produce-topic --messages 40 --per-second 20 --topic raw --output {at}/log --checkpoint {at}/pck"
    assert main(produce.split(), spark) == 0
    land = (
        f"land-topics --input {at}/log --topics raw,raw2 --output {at}/out --checkpoint {at}/ck"
        " --start-mode TRIM_HORIZON --until-caught-up"
    )
    assert main(land.split(), spark) == 0
    check = f"audit --input {at}/out --format json --expected".split()
    assert main([*check, "40"], spark) == 0
    assert "total=40 distinct_ids=40 duplicates=0 missing=0 unexpected=0" in capsys.readouterr().out
    assert main([*check, "41"], spark) == 1


def test_shards_by_window(spark, tmp_path, capsys):
    at = str(tmp_path)
    produce = f"produce-shards --messages 30 --per-second 30 --shards 2 --output {at}/log --checkpoint {at}/pck"
    assert main(produce.split(), spark) == 0
    land = f"land-shards --input {at}/log --output {at}/out --checkpoint {at}/ck --run-id abc --until-caught-up"
    assert main([*land.split(), "--start-mode", "TRIM_HORIZON"], spark) == 0
    check = f"audit --input {at}/out --expected 30 --per shard_id".split()
    assert main([*check, "--schema", "id bigint, shard_id string"], spark) == 0
    assert "shard-001" in capsys.readouterr().out


def test_days(spark, tmp_path):
    from millrace.operators import envelope
    from millrace.sinks.log import append_log

    value = F.to_json(F.struct(F.lit("2023-04-10").alias("day"), "id"))
    append_log(envelope.to_log(spark.range(5), F.lit("raw"), value, F.col("id")), f"{tmp_path}/log")
    land = f"land-days --input {tmp_path}/log --topics raw --output {tmp_path}/out --checkpoint {tmp_path}/ck"
    assert main([*land.split(), "--start-mode", "TRIM_HORIZON", "--until-caught-up"], spark) == 0
    assert spark.read.parquet(f"{tmp_path}/out").where("day = '2023-04-10'").count() == 5


@pytest.mark.parametrize("line", ["land-topics --topics a", "produce-topic --messages x", "none"])
def test_incomplete_arguments(line):
    with pytest.raises(SystemExit):
        parser().parse_args(line.split())
