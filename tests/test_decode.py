from streambed.operators.decode import decode_events, parse_index_fields, split_rejects

HEAD = '{"_event_id":"e1","_event_timestamp":"2024-01-01T00:00:00Z","_data":'
BAD = "invalid JSON"
CASES = [
    (HEAD + '{"hashUID":"u","authDuration":1.5,"piUsesFlag":null,"other":[1]}}', None),
    (HEAD + '{"hashUID":5}}', BAD),
    (HEAD + '{"authDuration":"1.5"}}', BAD),
    (HEAD + '{"authDuration":1e400}}', BAD),
    (HEAD + '{"piUsesFlag":true}}', BAD),
    (HEAD + "null}", None),
    (HEAD + "5}", BAD),
    (HEAD + "[]}", BAD),
    (HEAD + "{}} x", BAD),
    (HEAD + "{}},{}", BAD),
    (HEAD + "{}}],[{}", BAD),
    (HEAD + "{}}\r\n", None),
    ('{"_event_id":"a","_event_id":"b","_event_timestamp":"2024-01-01T00:00:00Z"}', None),
    ("null", "missing _event_id"),
    ("5", BAD),
    ("", BAD),
    ("{'_event_id':'q'}", BAD),
    ('{"_event_id":""}', "missing _event_id"),
    ('{"_event_id":"a"}', "missing _event_timestamp"),
    ('{"_event_id":"a","_event_timestamp":"x"}', "invalid _event_timestamp"),
    ('{"_event_id":1,"_event_timestamp":"2024-01-01T00:00:00Z"}', BAD),
    ('{"_event_id":"a","_event_timestamp":"2024-01-01T00:00:00Z","_version":NaN}', BAD),
    (None, BAD),
]


def _messages(spark):
    rows = [(text, "t", 0, at) for at, (text, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, "value string, topic string, partition int, offset long")


def test_reasons(spark):
    found = {r.offset: r.reason for r in decode_events(_messages(spark)).collect()}
    assert found == {at: reason for at, (_, reason) in enumerate(CASES)}


def test_accepted_and_rejected_are_all_messages(spark):
    events, rejects = split_rejects(decode_events(_messages(spark)))
    assert events.count() + rejects.count() == len(CASES)
    first = events.where("offset = 0").head()
    assert (first.reference_id, first.timestamp, first.payload) == ("u", 1704067200, CASES[0][0])


def test_unread_payload_fields_may_be_left_unchecked(spark):
    found = {r.offset: r.reason for r in decode_events(_messages(spark), strict=False).collect()}
    assert found[1] == BAD and found[8] == BAD
    assert found[2] is None


def test_index_fields(spark):
    lines = [
        '{"_event_id":"e","reference_id":"r","_event_timestamp":"5"}\r',
        '{"_event_id":"e","_data":{"hashUID":"h"}}',
        '{"_event_id":"e","_data":5}',
        '{"_event_id":5,"reference_id":"r"}',
        "",
        '{"_event_id":"e","reference_id":"r"} x',
    ]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, line string")
    got = {r.i: (r.reference_id, r.ts, r.status) for r in parse_index_fields(rows).collect()}
    assert got[0] == ("r", 5, "ok") and got[1] == ("h", 0, "ok")
    assert [got[i][2] for i in range(2, 6)] == ["skipped", "malformed", "malformed", "malformed"]
    strict = {r.i: r.status for r in parse_index_fields(rows, strict_reference=True).collect()}
    assert strict[1] == "skipped"
