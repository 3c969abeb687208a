import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialoom.operators import gates, models
from dialoom.streaming import responses


def test_retries_and_pauses():
    slept, said = [], iter([RuntimeError("HTTP 429"), RuntimeError("quota"), "fine"])

    def flaky():
        x = next(said)
        if isinstance(x, Exception):
            raise x
        return x

    assert models.call(flaky, sleep=slept.append) == ("fine", None, 3) and slept == [2.0, 4.0]

    def wrong():
        raise ValueError("no such thing")

    assert models.call(wrong, sleep=slept.append) == (None, "ValueError: no such thing", 1)
    assert models.call(wrong, retry=models.SPEECH, sleep=slept.append)[2] == 3 and slept[-2:] == [1.0, 2.0]
    assert models.Retry(attempts=8).pauses()[-2:] == [60.0, 60.0]


def test_plainer_form_after_a_form_error():
    def strict():
        raise ValueError("400 unknown field")

    assert models.call(strict, plainer=lambda: "plain", sleep=lambda _: None) == ("plain", None, 2)


def test_converse_stops_at_the_first_error(spark):
    def factory():
        def reply(history, query):
            if query == "bad":
                raise ValueError("broken")
            return f"{history.count('|')}:{query}"

        return reply

    rows = [(1, ["a", "bad", "c"], 1, []), (2, ["a", "b", "c"], 2, ["x"]), (3, ["a"], None, [])]
    df = spark.createDataFrame(rows, "manifest_line long, transcripts array<string>, next_turn int, prior array<string>")
    got = {r.manifest_line: [(t.turn_index, t.plain_text, t.error) for t in r.new_turns] for r in models.converse(df, factory, lambda said, replies: "|" * len(replies)).collect()}
    assert got == {1: [(1, "0:a", None), (2, None, "ValueError: broken")], 2: [(2, "1:b", None), (3, "2:c", None)], 3: []}


def test_apply_model_keeps_rows_and_logs(spark):
    df = spark.createDataFrame([("p", 1), (None, 2)], "text string, error int")
    done = models.apply_model(df, lambda: lambda rows: [len(t or "") for (t,) in rows], ["text"], T.StructField("n", T.LongType()))
    assert sorted((r.text or "", r.n, r.error, r.attempts) for r in done.collect()) == [("", 0, None, 1), ("p", 1, None, 1)]
    log = models.call_log(done.withColumn("answer", F.col("n").cast("string")), "m", "u", "text", "answer").collect()
    assert all(r.success and r.model == "m" for r in log) and sum(r.prompt_chars for r in log) == 1


def test_embedder_sees_whole_documents(spark, tmp_path, monkeypatch):
    from dialoom.plans import dialog_queries

    texts = ["a" * 50 + tail for tail in ("", " one", " two")] + ["é " * 3000 + "end", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    made, apply = [], models.apply_model
    monkeypatch.setattr(models, "apply_model", lambda *a, **b: made.append(apply(*a, **b)) or made[-1])
    assert dialog_queries.embed_documents(spark, str(tmp_path)).count() == len(texts)
    want = models.hash_embedder(8)()([(t,) for t in texts])
    assert {r.doc_id: r.v for r in made[0].collect()} == dict(enumerate(want))
    assert len({tuple(v) for v in want}) == len(texts)


def test_exit_codes():
    assert [gates.text_gate_exit(*a) for a in ((3, 0, True), (0, 0, True), (0, 0, False), (3, 1, True))] == [2, 1, 0, 0]
    assert gates.audio_gate_exit() == 0 and gates.audio_gate_exit(False) == 1
    assert (gates.reply_exit(0, 2), gates.reply_exit(1, 2), gates.reply_exit(0, 0)) == (1, 0, 0)


def test_stream_writes_each_line_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    schema = T.StructType.fromDDL("manifest_line long, transcripts array<string>")

    def reply(df):
        rows = df.select("manifest_line", "transcripts", F.lit(1).alias("next_turn"), F.array().cast("array<string>").alias("prior"))
        return models.converse(rows, models.echo_model, lambda said, replies: "")

    for k in range(2):
        (source / f"{k}.json").write_text(json.dumps({"manifest_line": k, "transcripts": ["ab", "c"]}) + "\n")
        query = responses.append_replies(responses.read_manifests(spark, str(source), schema), reply, str(tmp_path / "out"), str(tmp_path / "state"))
        query.awaitTermination()
        assert query.exception() is None
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("manifest_line").collect()
    assert [(r.manifest_line, len(r.new_turns)) for r in got] == [(0, 2), (1, 2)]


def test_windowed_usage_over_a_stream(spark, tmp_path):
    rows = [("2024-01-01 00:00:01", "m", 3), ("2024-01-01 10:00:00", "m", None), ("2024-01-03 00:00:00", "m", 1)]
    spark.createDataFrame(rows, "ts string, model string, total_tokens long").withColumn("ts", F.to_timestamp("ts")).write.parquet(str(tmp_path / "calls"))
    stream = spark.readStream.schema("ts timestamp, model string, total_tokens long").parquet(str(tmp_path / "calls"))
    query = responses.usage_by_window(stream).writeStream.outputMode("complete").format("memory").queryName("usage").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r.calls, r.total_tokens) for r in spark.sql("select * from usage").collect()) == [(1, 1), (2, 3)]


def test_a_failing_row_is_its_own_error(spark):
    def factory():
        def run(rows):
            if any(n == 2 for (n,) in rows):
                raise ValueError("bad")
            return [n for (n,) in rows]

        return run

    df = spark.createDataFrame([(n,) for n in range(5)], "n long").coalesce(1)
    got = models.apply_model(df, factory, ["n"], T.StructField("v", T.LongType())).collect()
    assert [(r.n, r.v, r.error) for r in got] == [(n, None if n == 2 else n, "ValueError: bad" if n == 2 else None) for n in range(5)]
    short = models.apply_model(df, lambda: lambda rows: [], ["n"], T.StructField("v", T.LongType())).collect()
    assert all(r.error == "ValueError: 0 outputs for 1 rows" and r.v is None for r in short)


def test_conversation_in_a_plainer_form(spark):
    def strict():
        def reply(history, query):
            raise ValueError("400 unknown field")

        return reply

    df = spark.createDataFrame([(1, ["a"], 1, [])], "manifest_line long, transcripts array<string>, next_turn int, prior array<string>")
    row = models.converse(df, strict, lambda said, replies: "", plainer=lambda: lambda history, query: query.upper()).first()
    assert row.new_turns[0].plain_text == "A" and row.n_api == 2


def test_objects_and_system_text():
    from dialoom.operators import media

    asked = []

    def model(system, prompt):
        asked.append((system, prompt))
        if system is not None:
            raise ValueError("Unknown name: systemInstruction")
        return "" if len(asked) < 3 else '```json\n{"a": 1}\n```'

    slept = []
    with pytest.raises(ValueError, match="empty model text"):
        media.generate_object(model, "S", "P", sleep=slept.append)
    assert asked[1] == (None, "System:\nS\n\nUser:\nP") and not slept
    assert media.generate_object(model, "S", "P") == '{"a": 1}'

    said = iter([RuntimeError("HTTP 503"), RuntimeError("quota"), '{"b": 2}'])

    def flaky(system, prompt):
        x = next(said)
        if isinstance(x, Exception):
            raise x
        return x

    assert media.generate_object(flaky, "S", "P", sleep=slept.append) == '{"b": 2}' and slept == [2.0, 4.0]


def test_decoding_falls_back(spark):
    from dialoom.operators import media

    def broken():
        def decode(data):
            raise ValueError("no codec")

        return decode

    stereo = media.pcm_file([0.5, -0.5, 0.25, 0.25], 8000, channels=2)
    df = spark.createDataFrame([(1, bytearray(stereo)), (2, bytearray(media.silence(0.0))), (3, None)], "id int, content binary")
    got = {r.id: r for r in media.decode_audio(df, broken, fallback=media.pcm_decoder()).collect()}
    assert [round(x, 3) for x in got[1].wave] == [0.0, 0.25] and got[1].rate == 8000
    assert got[2].error == "ValueError: decoding gave no samples" and got[3].wave is None and got[3].error
    both = media.decode_audio(df.filter("id = 1"), media.pcm_decoder(8000), mono=False).first().wave
    assert [[round(x, 3) for x in c] for c in both] == [[0.5, 0.25], [-0.5, 0.25]]
