from gatewatch.sources import kafka


def test_source_options():
    assert kafka.source_options("host:9092", "logins") == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "logins",
        "startingOffsets": "earliest", "failOnDataLoss": "true"}
    options = kafka.source_options("h", "t", 5000, False)
    assert options["failOnDataLoss"] == "false" and options["maxOffsetsPerTrigger"] == "5000"
