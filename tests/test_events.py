import json

from pyspark.sql import functions as F

from mnemosieve import streaming
from mnemosieve.operators import events as en
from mnemosieve.operators import instruments as im


def table(spark, rows):
    return spark.createDataFrame([(s, t, i, json.dumps(d)) for i, (s, t, d) in enumerate(rows)], "session_id string, type string, seq long, data string")


def message(turn, text, **more):
    return {"turn": turn, "step": 1, "message": {"role": "assistant", "content": [{"type": "text", "text": text}, {"type": "image"}]}} | more


def test_turn_final(spark):
    rows = table(spark, [("a", "assistant/message", message(1, "first")), ("a", "assistant/message", message(1, "last")), ("a", "assistant/message", message(1, "cut", interrupted=True)), ("a", "assistant/message", message(2, "next")), ("a", "other", {})])
    assert {tuple(r) for r in en.turn_final(rows).collect()} == {("a", 1, "last"), ("a", 2, "next")}


def test_contract(spark):
    rows = table(spark, [("a", "assistant/message", {"turn": "1", "step": 2, "message": {"content": "x"}}), ("a", "assistant/message", {"turn": 3}), ("b", "assistant/message", [1]), ("a", "compaction/end", {"compactionId": "k", "turn": None}), ("a", "compaction/end", {"compactionId": 5}), ("a", "other", {})])
    told = {r["seq"]: r["missing_fields"] for r in en.checked(rows).collect()}
    assert told[0] == ["turn (number)", "message.content (array)"] and told[1] == ["step (number)", "message.content (array)"] and len(told[2]) == 3
    assert told[3] == [] and told[4] == ["compactionId (string)", "turn (number-or-null)"] and told[5] is None
    assert sorted((r["session_id"], r["type"], r["seq"]) for r in en.violations(rows).collect()) == [("a", "assistant/message", 0), ("a", "compaction/end", 4), ("b", "assistant/message", 2)]


def test_once_only(spark):
    texts = spark.createDataFrame([("a", 1, 0, " \n"), ("a", 1, 1, "kept\n## Key Learnings:\n- x"), ("a", 1, 2, "late"), ("b", 1, 3, "b")], "session_id string, turn long, seq long, text string")
    got = {(r["session_id"], r["turn"]): (r["text"][:4], r["has_learnings"]) for r in en.capture_once(texts).collect()}
    assert got == {("a", 1): ("kept", True), ("b", 1): ("b", False)}
    summaries = spark.createDataFrame([("a", "k", 0, ""), ("a", "k", 1, "text"), ("a", "m", 2, "text"), ("a", "m", 3, "text")], "session_id string, compaction_id string, seq long, text string")
    assert {(r["compaction_id"], r["persisted"]) for r in en.summaries_once(summaries).collect()} == {("k", False), ("m", True)}


def test_injection(spark):
    rows = table(spark, [("a", "compaction/end", {"compactionId": "k", "turn": None}), ("a", "compaction/end", {"compactionId": "k", "turn": None}), ("a", "compaction/end", {"compactionId": "f", "turn": 1, "error": "x"}), ("a", "compaction/end", {"compactionId": "m", "turn": 4})])
    recalled = spark.createDataFrame([("a", "known")], "session_id string, recall string")
    assert {(r["compaction_id"], r["wakeup"]) for r in en.injections(rows, "Frame", recalled, 50).collect()} == {("k", True), ("m", False)}


def test_instruments(spark):
    ids = lambda rows: spark.createDataFrame(rows, "session_id string, id long")
    seen = ids([("a", 1), ("a", 2)])
    assert {tuple(r) for r in im.consistency(ids([("a", 1), ("a", 5), ("a", 5), ("b", 1)]), seen).collect()} == {("a", 1, 2), ("b", 0, 1)}
    verdicts = spark.createDataFrame([(0, "a", "supersedes", [1, 2]), (1, "a", "related", [3, 4]), (2, "a", "not_conflict", [1, 2]), (3, "a", "not_conflict", None)], "verdict_id long, session_id string, verb string, ids array<long>")
    r = im.verdict_counts(im.judged(verdicts, im.known_ids(ids([("a", 2)]), ids([("a", 1)])))).first()
    assert (r["read_first"], r["blind"], r["unknown"], r["verdicts"]) == (2, 1, 1, {"supersedes": 1, "related": 1, "not_conflict": 2})


def test_connections(spark):
    rows = spark.createDataFrame([("w1", 100, 0), ("w2", 50, 1), ("w3", 80, 0)], "workspace string, last_used long, in_flight long")
    assert en.least_recently_used(rows).first()[0] == "w3"
    assert [r[0] for r in en.idle(rows, 200, 110).collect()] == ["w3"] and en.idle(rows, 200, 0).isEmpty()


def test_stream_equals_batch(spark, tmp_path):
    rows = [("a", 1, 0, " "), ("a", 1, 1, "x"), ("a", 1, 2, "y"), ("b", 2, 3, "z")]
    df = spark.createDataFrame(rows, "session_id string, turn long, seq long, text string").withColumn("at", F.timestamp_seconds(F.col("seq")))
    df.write.parquet(f"{tmp_path}/in")
    stream = streaming.capture(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"))
    got = streaming.run_once(stream, f"{tmp_path}/out", f"{tmp_path}/log")
    assert {(r["session_id"], r["turn"]) for r in got.collect()} == {(r["session_id"], r["turn"]) for r in en.capture_once(df).collect()}


def test_window_counters(spark, tmp_path):
    df = spark.createDataFrame([(1, "click", 2.0, 10), (1, "click", 3.0, 20), (1, "click", 1.0, 100_000)], "user_id long, event_type string, value double, s long").withColumn("ts", F.timestamp_seconds("s"))
    df.write.parquet(f"{tmp_path}/in")
    stream = streaming.counters(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"))
    got = streaming.run_once(stream, f"{tmp_path}/out", f"{tmp_path}/log")
    assert [(r["n"], r["total_value"]) for r in got.collect()] == [(2, 5.0)]


def test_stream_instruments(spark, tmp_path):
    schema = "session_id string, seq long, kind string, ids array<long>, verb string"
    rows = [("a", 0, "saved", [1], None), ("a", 1, "read", [2], None), ("a", 2, "verdict", [1, 2], "supersedes"), ("a", 3, "verdict", [3, 4], "related"), ("a", 4, "verdict", None, "not_conflict"), ("b", 0, "verdict", [1], "related"), ("b", 1, "end", None, None)]
    later = [("a", 5, "verdict", [2, 1], "not_conflict"), ("b", 2, "verdict", None, "related")]
    got = {}
    for i, batch in enumerate((rows, later)):
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
        stream = streaming.instruments(spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in"), idle_ms=None)
        sink = stream.writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/log").trigger(availableNow=True)
        sink.foreachBatch(lambda df, _: got.update({r["session_id"]: r for r in df.collect()})).start().awaitTermination()
    a, b = got["a"], got["b"]
    assert (a["read_first"], a["blind"], a["unknown"], a["verdicts"]) == (2, 1, 1, {"supersedes": 1, "related": 1, "not_conflict": 2})
    assert (b["read_first"], b["blind"], b["unknown"], b["verdicts"]) == (0, 0, 1, {"related": 1})
