import csv
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom import schemas
from threadloom.operators import incremental as I
from threadloom.plans import corpus as CP
from threadloom.plans import triage as TR
from threadloom.sources import tables as IO
from threadloom.streaming import triage_stream as ST

CLASSES = {"A": ["late", "lost"], "B": ["refund"]}


@pytest.fixture()
def taxonomy(spark):
    return spark.createDataFrame(
        [("A", "auto", "track"), ("B", "escalate", "money")],
        "id string, escalation_default string, escalation_note string",
    )


def test_csv_keeps_quotes_breaks_and_blanks(spark, tmp_path):
    text = ' a "quoted", b\nnext line\\ '
    rows = [("1", "u", "True", "t", text, None, None), ("2", "u", "NA", "t", "", "null", "1")]
    df = spark.createDataFrame(rows, schemas.RAW_MESSAGES)
    IO.write_csv(df, str(tmp_path / "c"))
    plain = {r.tweet_id: r for r in
             IO.read_csv(spark, str(tmp_path / "c"), schemas.RAW_MESSAGES).collect()}
    assert plain["1"].text == text and plain["1"].in_response_to_tweet_id is None
    assert plain["2"].text is None and plain["2"].inbound == "NA"
    landed = IO.land_csv(spark, str(tmp_path / "c"), schemas.RAW_MESSAGES, str(tmp_path / "p"),
                         IO.COMMON_MISSING_WORDS)
    row = landed.where("tweet_id = '2'").first()
    assert row.inbound is None and row.response_tweet_id is None


@pytest.mark.parametrize(("seed", "end", "size"), [(1, "\n", 700), (2, "\r\n", 64), (3, "\n", 1 << 20)])
def test_csv_ranges_that_begin_inside_quotes(spark, tmp_path, seed, end, size):
    rng = random.Random(seed)
    parts = ["plain", "two\nlines", '"quoted"', "a,b", "\n\n", "", "x" * 90, "\u00d6l", " blank ", "cr\r\nlf", '"', "\n\"\n"]
    rows = [(str(i), "".join(rng.choices(parts, k=rng.randint(0, 5))), rng.choice(parts)) for i in range(400)]
    for name, mine in (("a.csv", rows[:390]), ("b.csv", rows[390:]), ("c.csv", [])):
        with open(tmp_path / name, "w", encoding="utf-8", newline="") as out:
            writer = csv.writer(out, lineterminator=end)
            writer.writerow(["id", "head\nline", "z"])
            writer.writerows(mine)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "y", "z")])
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, size)
        lines = IO.quoted_csv._lines(spark, str(tmp_path))
        assert size > 1000 or lines.rdd.getNumPartitions() > 8
        got = IO.read_csv(spark, str(tmp_path), schema).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.id: (r.y, r.z) for r in got} == {i: (y or None, z or None) for i, y, z in rows} and len(got) == 400


def test_csv_with_stray_quotes(spark, tmp_path):
    (tmp_path / "s.csv").write_text('id,y\n1,5" pipe\n2,"a\nb"\n', encoding="utf-8")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "y")])
    got = IO.read_csv(spark, str(tmp_path), schema, stray_quotes=True)
    assert {tuple(r) for r in got.collect()} == {("1", '5" pipe'), ("2", "a\nb")}


def test_json_array_and_lines(spark, tmp_path):
    records = [
        {"message_id": "a", "retrieved_hits": [{"idx": 1, "reply_text": "r", "score": 0.5}],
         "confidence": 1.0, "extra": 1},
        {"message_id": "b", "retrieved_hits": []},
    ]
    (tmp_path / "r.json").write_text(json.dumps(records, indent=2), encoding="utf-8")
    df = IO.read_json_array(spark, str(tmp_path / "r.json"), schemas.AGENT_RESULTS)
    rows = {r.message_id: r for r in df.collect()}
    assert rows["a"].retrieved_hits[0].score == 0.5 and rows["b"].confidence is None
    IO.write_json_lines(df, str(tmp_path / "l"))
    again = IO.read_json_lines(spark, str(tmp_path / "l"), schemas.AGENT_RESULTS)
    assert sorted(again.collect()) == sorted(df.collect())


def test_work_folder_uses_the_checkpoint_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = IO.work_folder(spark, "x"), IO.work_folder(spark, "x")
    assert first != second
    assert base is None or first.startswith(base)


def test_resume_processes_only_what_is_new(spark, tmp_path):
    out, calls = str(tmp_path / "out"), []

    def work(rows):
        calls.append(rows.count())
        return rows.withColumn("run", F.lit(len(calls)))

    first = spark.createDataFrame([("a",), ("b",)], "id string")
    second = spark.createDataFrame([("b",), ("c",)], "id string")
    I.resume(first, out, "id", work)
    got = I.resume(second, out, "id", work).collect()
    assert calls == [2, 1]
    assert sorted((r.id, r.run) for r in got) == [("a", 1), ("b", 1), ("c", 2)]


def test_a_run_that_was_not_committed_does_not_count(spark, tmp_path):
    out = str(tmp_path / "out")

    def work(rows):
        return rows.withColumn("twice", F.col("v") * 2)

    rows = [("a", 3, {"k": "x"}), ("a", 1, {"k": "y"}), ("b", 5, None), (None, 7, None)]
    source = spark.createDataFrame(rows, "id string, v int, m map<string,string>")
    log = I.RunLog(spark, out)
    # stopped between write and commit
    log.write(work(I.unique_rows(source, "id")).withColumn("v", F.lit(-9)).withColumn("_bucket", I.bucket("id")), log.next_name())
    assert log.read() is None and log.runs() == []
    got = I.resume(source, out, "id", work)
    assert sorted((r.id, r.v, r.twice, r.m) for r in got.collect()) == [("a", 1, 2, {"k": "y"}), ("b", 5, 10, None)]
    more = spark.createDataFrame([("b", 0, None), ("c", 4, None)], source.schema)
    for again in (more, more):  # the second time there is nothing to do
        got = I.resume(again, out, "id", work)
        assert sorted((r.id, r.v) for r in got.collect()) == [("a", 1), ("b", 5), ("c", 4)]
    before = sorted(got.drop("m").collect())
    log.write(more.withColumn("twice", F.lit(0)).withColumn("_bucket", F.lit(0)), "merged-00000000")  # a merge that stopped
    assert sorted(log.read().drop("m", "_bucket").collect()) == before
    log.merge()
    assert log.runs() == ["merged-00000000"]
    assert sorted(log.read().drop("m", "_bucket").collect()) == before
    got = I.resume(spark.createDataFrame([("d", 8, None)], source.schema), out, "id", work)
    assert sorted(r.id for r in got.collect()) == ["a", "b", "c", "d"] and len(log.runs()) == 2
    with pytest.raises(Exception, match="exist"):
        log.commit(log.runs()[0], source.schema)


def test_stream_state_is_bounded(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = spark.createDataFrame([], "message_id string, v int").schema
    seen = []
    for day in range(3):
        rows = [(f"m{i}", day) for i in range(day * 20, day * 20 + 60)] + [("m0", day), (None, day)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = ST.read_new_files(spark, source, schema)
        got = ST.run_available(stream, lambda df: df, out, check, progress=seen)
        assert got.count() == 60 + 20 * day
    assert {r.message_id: r.v for r in got.collect()} == {f"m{i}": max(0, (i - 40) // 20) for i in range(100)}
    assert len(seen) == 3 and all(not p.stateOperators for p in seen)  # no id is remembered by the stream
    log = I.RunLog(spark, out)
    I.add_run(log, got.limit(1).withColumn("message_id", F.lit("new")), "message_id", lambda df: df, log.runs()[-1])
    assert ST.run_available(ST.read_new_files(spark, source, schema), lambda df: df, out, check).count() == 100


def test_stream_with_event_time_keeps_a_window_of_ids(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = spark.createDataFrame([], "message_id string, at timestamp").schema
    seen = []
    for day in range(5):
        rows = spark.range(day * 10, day * 10 + 30).select(
            F.concat(F.lit("m"), "id").alias("message_id"), F.timestamp_seconds(F.lit(86400 * (100 + 3 * day))).alias("at")
        )
        rows.coalesce(1).write.mode("append").parquet(source)
        got = ST.run_available(ST.read_new_files(spark, source, schema), lambda df: df, out, check, event_time="at", progress=seen)
    assert got.count() == 70 and got.select("message_id").distinct().count() == 70
    held = [o.numRowsTotal for p in seen for o in p.stateOperators]
    assert held and max(held) <= 90 and held[-1] <= 60  # of 150 rows


def test_stream_continues_and_agrees_with_batch(spark, tmp_path, taxonomy):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    rows = [("1", "lost and late"), ("2", "refund the fraud"), ("3", "hello")]
    late = [("3", "hello"), ("4", "a refund")]
    schema = "message_id string, input_text string"

    def work(df):
        return TR.triage(df, CLASSES, taxonomy, fallback="A")

    def run():
        stream = ST.read_new_files(spark, source, spark.createDataFrame([], schema).schema)
        return ST.run_available(stream, work, out, check)

    spark.createDataFrame(rows, schema).write.parquet(source)
    assert run().count() == 3
    spark.createDataFrame(late, schema).write.mode("append").parquet(source)
    got = sorted(run().collect())
    assert got == sorted(work(spark.createDataFrame(rows + late[1:], schema)).collect())
    by = {r.message_id: r for r in got}
    assert (by["1"].pred_intent, by["1"].confidence, by["1"].pred_decision) == ("A", 0.4, "auto")
    assert by["2"].pred_reason == "High-risk keyword(s) detected: ['fraud']"
    assert (by["3"].pred_intent, by["3"].confidence) == ("A", 0.1)
    assert (by["4"].pred_decision, by["4"].pred_reason) == ("escalate", "money")


def test_build_corpus(spark):
    rows = [(f"q{i}", "u", True, "t", f"my parcel number {i} is late", None) for i in range(30)]
    rows += [(f"a{i}", "shop", False, "t", f"we are looking for parcel {i}", f"q{i}")
             for i in range(25)]
    messages = spark.createDataFrame(
        rows, "tweet_id string, author_id string, inbound boolean, created_at string, text string, "
        "in_response_to_tweet_id string",
    )
    corpus = CP.build_corpus(messages, CLASSES, "shop", size=20).collect()
    assert sorted(r.idx for r in corpus) == list(range(20))
    assert {r.intent_seed for r in corpus} == {"A"}
    again = CP.build_corpus(messages.repartition(5), CLASSES, "shop", size=20).collect()
    assert sorted(corpus) == sorted(again)
    pairs = CP.matched_pairs(messages, "shop")
    report = CP.corpus_report(messages, CP.corpus_of(pairs, CLASSES), "shop", pairs=pairs)
    assert {r.metric: r.value for r in report.collect()} == {
        "total_rows": 55.0, "brand_replies": 25.0, "matched_pairs": 25.0, "indexed_corpus": 25.0,
        "class:A": 25.0, "share:A": 1.0,
    }


def test_retrieval_agent(spark, taxonomy):
    corpus = spark.createDataFrame(
        [(1, "lost", "we found it", [1.0, 0.0]), (2, "refund", "money is back", [0.0, 1.0])],
        "idx long, customer_text string, reply_text string, vec array<float>",
    )
    questions = spark.createDataFrame(
        [(1, "it is lost", [1.0, 0.1]), (7, "a refund", [0.1, 1.0])],
        "message_id long, input_text string, vec array<float>",
    )
    rows = {r.message_id: r for r in
            TR.retrieval_agent(questions, corpus, CLASSES, taxonomy, k=1).collect()}
    assert rows[1].draft_reply == "money is back"  # its own thread is not an answer
    assert rows[7].draft_reply == "money is back"
    assert (rows[7].pred_intent, rows[7].pred_decision) == ("B", "escalate")
    alone = TR.retrieval_agent(questions, corpus.where("idx = 1"), CLASSES, taxonomy)
    drafts = {r.message_id: r.draft_reply for r in alone.collect()}
    assert drafts[1] == "Please contact us for assistance with your request."


def test_retrieval_agent_searches_for_wanted_questions_only(spark, taxonomy, monkeypatch):
    corpus = spark.createDataFrame(
        [(1, "lost", "we found it", [1.0, 0.0]), (2, "refund", "money is back", [0.0, 1.0])],
        "idx long, customer_text string, reply_text string, vec array<float>",
    )
    questions = spark.createDataFrame(
        [(1, "it is lost", [1.0, 0.1]), (7, "a refund", [0.1, 1.0]), (7, "lost", None), (None, "x", [1.0, 1.0])],
        "message_id long, input_text string, vec array<float>",
    )
    wanted = spark.createDataFrame([("7",), ("9",), ("7",), (None,)], "message_id string")
    asked, search = [], TR.top_k
    monkeypatch.setattr(TR, "top_k", lambda c, q, *a: asked.append(q.count()) or search(c, q, *a))
    every = TR.retrieval_agent(questions, corpus, CLASSES, taxonomy, k=1)
    some = TR.retrieval_agent(questions, corpus, CLASSES, taxonomy, k=1, wanted=wanted)
    assert asked == [4, 2]
    assert sorted(map(str, some.collect())) == sorted(map(str, every.where("message_id = 7").collect()))
