import pytest
from pyspark.sql import functions as F

from streambed import schemas
from streambed.functions.keys import is_segment_key, parse_segment_key
from streambed.functions.sharding import hash_hex, shard_of
from streambed.functions.times import lenient_seconds, strict_seconds
from streambed.session import small_files
from streambed.sources.segments import file_path

TIMES = [
    ("2024-01-01T00:00:00Z", 1704067200, 1704067200),
    ("2024-01-01T00:00:00.123456789Z", 1704067200, 1704067200),
    ("2024-01-01T00:00:00,5Z", 1704067200, 1704067200),
    ("2024-01-01T00:00:00+05:30", 1704047400, 1704047400),
    ("2024-01-01T00:00:00-23:00", 1704150000, 1704150000),
    ("2024-01-01T00:00:00", 1704067200, 1704067200),
    ("1960-01-01T00:00:00.5Z", -315619200, -315619200),
    ("2024-01-01 00:00:00", None, 0),
    ("2024-01-01", None, 0),
    ("2024-01-01T00:00:00+0530", None, 0),
    ("2024-01-01T24:00:00Z", None, 0),
    ("2024-02-30T00:00:00Z", None, 0),
    ("2024-01-01T00:00:00Z\n", None, 0),
    ("1704067200", None, 1704067200),
    ("-7", None, -7),
    (" 7", None, 0),
    ("99999999999999999999", None, 0),
    ("", None, 0),
    (None, None, 0),
]


def test_payload_has_its_fields():
    assert len(schemas.PAYLOAD_TEXT_FIELDS) == 102
    assert len(schemas.PAYLOAD_NUMBER_FIELDS) == 76
    assert "hashUID" in schemas.PAYLOAD_TEXT_FIELDS


def test_the_usual_form_reads_as_its_parts_do(spark):
    import random

    from streambed.functions.times import _from_parts
    rng = random.Random(9)
    texts = ["+024-01-01T00:00:00Z", "2024-01-01T+1:00:00Z", "2024-01-01T 1:00:00Z", "\uff12024-01-01T00:00:00Z", "0000-01-01T00:00:00Z", "9999-12-31T23:59:59Z"]
    for _ in range(3000):
        text = list("2024-02-28T23:59:59Z")
        for _ in range(rng.choice([1, 1, 2, 5])):
            text[rng.randrange(20)] = rng.choice("0123456789+-:. TZz\u0661")
        texts.append("".join(text))
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", strict_seconds(F.col("t")).alias("a"), _from_parts(F.col("t")).alias("b")).collect()
    assert [r.t for r in rows if r.a != r.b] == [] and sum(r.a is not None for r in rows) > 500


def test_event_times(spark):
    rows = spark.createDataFrame(TIMES, "text string, strict long, lenient long")
    found = rows.select(
        "*", strict_seconds(F.col("text")).alias("s"), lenient_seconds(F.col("text")).alias("l")
    ).collect()
    for row in found:
        assert (row.text, row.s, row.l) == (row.text, row.strict, row.lenient)


@pytest.mark.parametrize(
    ("key", "want"),
    [
        ("events/1700000000/i1/s1.ndjson", (1700000000, "i1", "s1")),
        ("a/1/b/c/d.ndjson", (1, "b", "c")),
        ("events/1/i1/s.ndjson.ndjson", (1, "i1", "s.ndjson")),
        ("events/x/i1/s1.ndjson", None),
        ("events/ 1/i1/s1.ndjson", None),
        ("events/1/i1", None),
    ],
)
def test_segment_keys(spark, key, want):
    got = spark.range(1).select(parse_segment_key(F.lit(key)).alias("k")).head().k
    assert (tuple(got) if got else None) == want


SHARD_VECTORS = [
    ("", "4cf7231fbfebf7a8", 0, 0, 5, 11),
    ("0", "b3e846f31df5b748", 0, 2, 2, 2),
    ("1", "b3e847f31df5b8fb", 0, 1, 1, 1),
    ("8", "b3e83ef31df5a9b0", 0, 1, 4, 13),
    ("46", "a9757d1be89213c6", 0, 1, 4, 12),
    ("abc", "0b91786d0de5b218", 0, 3, 3, 11),
    ("hé", "bd405d6ce16fbe90", 0, 1, 1, 10),
]


def test_shard_vectors(spark):
    rows = spark.createDataFrame([(v[0],) for v in SHARD_VECTORS], "r string")
    found = rows.select(
        "r", hash_hex(F.concat(F.lit("ref:"), "r")), *[shard_of(F.col("r"), n) for n in (1, 4, 6, 16)]
    )
    assert sorted(map(tuple, found.collect())) == sorted(SHARD_VECTORS)


def test_more_shards_move_keys_only_to_new_shards(spark):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("r"))
    moved = rows.select(shard_of(F.col("r"), 10).alias("a"), shard_of(F.col("r"), 11).alias("b")).where("a <> b")
    assert moved.where("b <> 10").count() == 0
    assert 0 < moved.count() < 5000 / 5


def test_a_key_is_told_well_formed_as_it_is_parsed(spark):
    keys = [
        "events/1/w/s.ndjson", "events/1/w/", "events/1/w", "events/x/w/s", "a/b/1/w/s", "events/-7/w/s", "events/+7//s/x", "/1//",
        "events/99999999999999999999/w/s", "events/00000000000000000000001/w/s", "events/1 /w/s", "", None, "e\nv/1/w\n/s", "events/1\n/w/s",
    ]
    rows = spark.createDataFrame([(k,) for k in keys], "key string")
    told = rows.select("key", is_segment_key(F.col("key")).alias("told"), parse_segment_key(F.col("key")).isNotNull().alias("parsed")).collect()
    assert [bool(r.told) for r in told] == [r.parsed for r in told]


def test_the_path_of_a_file_is_decoded(spark, tmp_path):
    for name in ("plain", "a+b", "a b%41+é"):
        spark.range(1).write.parquet(str(tmp_path / name))
        found = spark.read.parquet(str(tmp_path / name)).select(file_path()).head()[0]
        assert f"{tmp_path}/{name}/part-" in found


def test_small_files_hold_inside_only(spark):
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    with pytest.raises(ValueError), small_files(spark):
        assert spark.conf.get(key) == "65536"
        raise ValueError
    assert spark.conf.get(key) == before
