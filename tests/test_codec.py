"""Envelope encode / decode, subjects, sizes, quarantine reasons."""

from pyspark.sql import functions as F

from tributary.functions import codec
from tributary.functions import envelope as env


OPERATION_WORDS = {"index": "index", "update": "update", "partial_update": "partial", "delete": "delete"}


def test_subject_parts(spark):
    names = ["stock-9-x", "a.b-c", "", "plain", "-", "ü-ñ"]
    df = spark.createDataFrame([(n, o, f"t{i}") for i, n in enumerate(names) for o in OPERATION_WORDS],
                               "index string, operation string, tenant string")
    for r in df.select("*", env.subject(F.col("tenant")).alias("s"), env.subject(F.col("tenant"), prefix="hop").alias("h")).collect():
        head, tenant, rest = r["s"].split(".", 2)
        assert (head, tenant) == ("es", r["tenant"])
        assert rest == r["index"].replace("-", "_") + "." + OPERATION_WORDS[r["operation"]]
        assert r["h"] == "hop" + r["s"][2:]


ALL_FIELDS = ("msg_id string, timestamp timestamp, source_id string, sequence bigint, primary_term bigint, "
              "correlation_id string, headers map<string,string>, operation string, index string, doc_id string, "
              "doc_type string, version bigint, routing string, pipeline string, source string")


def test_every_field_survives_the_wire(spark):
    from datetime import datetime
    when = datetime(2031, 2, 3, 4, 5, 6, 789)
    rows = [("5f0c1d2e-0001-4aaa-8bbb-00000000000a", when, "north", 7, 3, "c-1", {"k": "v", "é": "\"q\""}, "update",
             "stock-9", "né/1", "special", 12, "r1", "p1", '{"n":{"deep":[1.0,{"x":null}]},"t":"é \\u0041"}'),
            ("5f0c1d2e-0002-4aaa-8bbb-00000000000b", when, "north", 0, None, None, None, "delete", "b", "2", None, None,
             None, None, None),
            ("5f0c1d2e-0003-4aaa-8bbb-00000000000c", when, "", 9, 0, "", {}, "partial_update", "", "", "_doc", 0, "", "", "{}")]
    df = spark.createDataFrame(rows, ALL_FIELDS)
    sent = df.select("sequence", codec.encode(doc_type="doc_type", version="version", primary_term="primary_term",
                                              correlation_id="correlation_id", headers="headers", routing="routing",
                                              pipeline="pipeline").alias("payload"))
    back = {r["sequence"]: r.asDict() for r in codec.decode(sent).collect()}
    names = [c.split()[0] for c in ALL_FIELDS.split(", ")]
    for row in rows:
        want = dict(zip(names, row))
        want["doc_type"] = want["doc_type"] or "_doc"
        want["headers"] = want["headers"] or None
        got = back[want["sequence"]]
        assert got["reason"] is None
        assert {k: got[k] for k in names if k != "source"} == {k: want[k] for k in names if k != "source"}
        assert (got["source"] is None) == (want["source"] is None)
    assert back[7]["source"].startswith('{"n":{"deep":[1.0,{"x":null}]},"t":"')
    text = {r["sequence"]: r["payload"] for r in sent.collect()}
    assert not any(k in text[0] for k in ("version", "headers", "routing", "pipeline", "primary_term", '"source":{'))


def test_body_text_comes_back_compact(spark):
    df = spark.createDataFrame([(1, '{ "b" : [ 1, 2.50 ],  "a" : { "z" : "x  y" } }')], "sequence bigint, source string")
    df = df.select("*", F.lit("n").alias("source_id"), F.lit("index").alias("operation"), F.lit("i").alias("index"),
                   F.lit("d").alias("doc_id"), F.lit("2031-01-01").cast("timestamp").alias("timestamp"))
    got = codec.decode(df.withColumn("msg_id", env.message_id()).select(codec.encode().alias("payload"))).first()
    assert got["reason"] is None and got["source"].replace("2.50", "2.5") == '{"b":[1,2.5],"a":{"z":"x  y"}}'


def test_decode_reasons(spark):
    base = ('{"metadata":{"msg_id":"%s","timestamp":"2024-01-01T00:00:00Z","source":"s","sequence":%s},'
            '"event":{"operation":"%s","index":"i"%s}}')
    good_id = "0190a6b4-1c2d-7e3f-8a9b-0c1d2e3f4a5b"
    rows = [
        ('{"metadata":',),
        (base % (good_id, "1", "index", ""),),
        (base % (good_id, "1", "bogus", ',"doc_id":"d"'),),
        (base % (good_id, "-1", "index", ',"doc_id":"d"'),),
        (base % ("not-a-uuid", "1", "index", ',"doc_id":"d"'),),
        (base % (good_id, "18446744073709551615", "index", ',"doc_id":"d"'),),
        (base % (good_id, "7", "partial_update", ',"doc_id":"d","source":{"a":1}'),),
    ]
    got = [r["reason"] for r in codec.decode(spark.createDataFrame(rows, "payload string")).collect()]
    assert got == ["malformed", "missing_field", "bad_operation", "bad_sequence", "bad_msg_id", "bad_sequence", None]


def test_sizes(spark):
    df = spark.createDataFrame([("é", "ab", "c"), (None, "ab", "c")], "source string, index string, doc_id string")
    got = [tuple(r) for r in df.select(env.event_size(), env.envelope_size()).collect()]
    assert got == [(5, 205), (3, 203)]


def test_headers_last_write_wins(spark):
    df = spark.range(1)
    h = env.with_header(F.lit(None).cast("map<string,string>"), "a", "1")
    h = env.with_header(env.with_header(h, "b", "2"), "a", "3")
    assert df.select(h.alias("h")).first()["h"] == {"b": "2", "a": "3"}
