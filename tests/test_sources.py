from rillet.schemas import SIGNAL
from rillet.sources import decode_json, kafka_options, read_csv_lines, split_quarantine, with_event_time


def test_json_quarantine(spark):
    raw = spark.createDataFrame([
        ('{"createTime":"2024-01-01 10:00:00","baselineId":3,"signalValue":0.5}',),
        ('{"createTime":"junk","baselineId":"x"}',),
        ('{"createTime":',),
    ], "value string")
    df = with_event_time(decode_json(raw, SIGNAL), "createTime")
    good, bad = split_quarantine(df, required=("ts", "baselineId"))
    assert good.count() == 1 and bad.count() == 2
    assert good.first().ts.hour == 10


def test_csv_lines_keep_commas(spark, tmp_path):
    p = tmp_path / "lines.csv"
    p.write_text('To be, or not to be\n"quoted, ""line"""\nplain\n')
    got = [r.line for r in read_csv_lines(spark, str(p)).collect()]
    assert got == ["To be, or not to be", 'quoted, "line"', "plain"]


def test_kafka_options():
    o = kafka_options("t", "kafka:9092", "g", "latest-offset")
    assert o == {"subscribe": "t", "kafka.bootstrap.servers": "kafka:9092", "startingOffsets": "latest",
                 "kafka.group.id": "g"}


def test_kafka_options_from_connector_both_spellings():
    from rillet.sources import kafka_options_from_connector

    current = {"connector": "kafka", "topic": "signal", "properties.bootstrap.servers": "kafka:9092",
               "properties.group.id": "g1", "scan.startup.mode": "latest-offset", "value.format": "json"}
    legacy = {"connector.type": "kafka", "connector.version": "universal", "connector.topic": "signal",
              "connector.properties.bootstrap.servers": "kafka:9092", "connector.properties.group.id": "g1",
              "connector.startup-mode": "latest-offset", "format.type": "json"}
    expect = {"subscribe": "signal", "kafka.bootstrap.servers": "kafka:9092", "kafka.group.id": "g1",
              "startingOffsets": "latest"}
    assert kafka_options_from_connector(current) == expect
    assert kafka_options_from_connector(legacy) == expect


def test_register_views(spark):
    from rillet.sources import register_views

    names = register_views(spark, "/root/testdata/sf0.001", ["nation", "events", "missing_table"])
    assert names == ["nation", "events"]
    assert spark.table("nation").count() == 25
    assert spark.sql("SELECT count(*) AS n FROM events").first().n == 1000


def test_decode_kafka_shaped_records(spark):
    from rillet.schemas import BITS

    raw = spark.createDataFrame([
        (bytearray(b'{"createTime":"2024-01-01 00:00:01","binaryInt":1}'), 0, 10),
        (bytearray(b'not json'), 0, 11),
    ], "value binary, partition int, offset long")
    df = decode_json(raw, BITS, "value", keep=("partition", "offset"))
    rows = sorted(df.collect(), key=lambda r: r.offset)
    assert (rows[0].binaryInt, rows[0].offset, rows[0]._corrupt_record) == (1, 10, None)
    assert rows[1]._corrupt_record == "not json"
