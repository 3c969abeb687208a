import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialoom import schemas
from dialoom.operators import usage
from dialoom.sources import jsonl

SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


@pytest.fixture
def lines(tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"a": 1}\n\n  \n{"a": 2, "b": "é"}\nbroken\n{"a": 3} {"a": 4}\n{"a": 5}', encoding="utf-8")
    return str(path)


def test_bad_lines(spark, lines):
    read = lambda bad: [(r.line_no, r.a) for r in jsonl.jsonl_scan(spark, lines, SCHEMA, bad).orderBy("line_no").collect()]
    assert read("skip") == [(1, 1), (2, 2), (5, 5)]
    rows = jsonl.jsonl_scan(spark, lines, SCHEMA, "null").orderBy("line_no").collect()
    assert len(rows) == 5 and rows[2].error == "invalid JSON" and rows[2].a is None
    assert read("drop") == [(1, 1), (2, 2), (3, 5)]
    with pytest.raises(Exception, match="3: invalid JSON"):
        jsonl.jsonl_scan(spark, lines, SCHEMA, "raise").collect()


def test_one_object_a_line(spark):
    good = ['{}', ' {"a": [1, {"b": 2}]} ', '{"a": "}]"}']
    bad = ['{"a": 1} {"a": 2}', '{"a": 1}, {"a": 2}', '{"a": 1}] [{"a": 2}', '{"a": 1}} {"a": {"b": 2}', '{"a": 1}, "b": {}', "[{}]", "1", "{", "{'a': 1}"]
    df = spark.createDataFrame([(x,) for x in good + bad], "line string").coalesce(1)
    assert [r[0] for r in df.select(jsonl._wellformed(F.col("line"))).collect()] == [True] * len(good) + [False] * len(bad)


def test_logs(spark, tmp_path):
    for name, rows in {"stats/m1/amy_2024-01.jsonl": [(1, True), (2, None)], "stats/m2/stage2_5_qc_2024-02.jsonl": [(None, False)]}.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("".join(json.dumps({"timestamp": "t", "prompt_tokens": p, "completion_tokens": p, "total_tokens": p, "success": s}) + "\n" for p, s in rows) + "{bad\n")
    got = jsonl.stats_logs(spark, str(tmp_path))
    by = {r.user: (r.model, r.stem) for r in got.collect()}
    assert by == {"amy": ("m1", "amy_2024-01"), "stage2_5": ("m2", "stage2_5_qc_2024-02")}
    assert {r.user for r in jsonl.stats_logs(spark, str(tmp_path), exact_users=True).collect()} == {"amy", "stage2_5_qc"}
    total = usage.usage_total(got).first()
    assert (total.calls, total.succeeded, total.failed, total.zero_output, total.total_tokens) == (3, 2, 1, 1, 3)
    assert usage.usage_total(usage.in_month(got, "2024-01")).first().calls == 2


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("é", None)], "b string, a int")
    jsonl.write_jsonl(df.coalesce(1), str(tmp_path / "out"))
    text = "".join(p.read_text("utf-8") for p in (tmp_path / "out").glob("part-*"))
    assert text.strip() == '{"a":null,"b":"é"}'
    jsonl.write_csv(usage.export_rows(spark.createDataFrame([(1, True)], "id int, success boolean").coalesce(1), {"id": "编号", "success": "成功"}), str(tmp_path / "csv"))
    text = "".join(p.read_text("utf-8") for p in (tmp_path / "csv").glob("part-*"))
    assert text.split() == ["编号,成功", "1,是"]
    assert jsonl.log_paths("m", "u", "2024-03-05") == ("calls/m/2024-03/2024-03-05.jsonl", "stats/m/u_2024-03.jsonl")


def test_audio_and_labels_paths(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        jsonl.audio_files(spark, str(tmp_path))
    for n in ("b.m4a", "a.m4a", "c.wav"):
        (tmp_path / n).write_bytes(b"x")
    assert [r.name for r in jsonl.audio_files(spark, str(tmp_path)).collect()] == ["a.m4a", "b.m4a"]
    there = {"asr"}.__contains__
    assert jsonl.labels_path(None, "filled", "asr", there) == "asr"
    assert jsonl.labels_path(None, "filled", "asr", there, manual_review=True) == "filled"
    assert jsonl.labels_path("own", "filled", "asr", there) == "own"


def test_schemas(spark):
    for name in ("turns", "labels", "dialogs", "responses", "text_verdicts", "audio_verdicts"):
        assert len(schemas.schema(name))


def test_logs_are_read_as_they_were_written(spark, tmp_path):
    rows = [("2024-01-31T10:00:00", "m/1", "amy_b+c", 3), ("2024-02-01T10:00:00", "m/1", "amy_b+c", 4), ("2024-02-01T11:00:00", "m2", "x", None)]
    calls = spark.createDataFrame(rows, "timestamp string, model string, user string, total_tokens long")
    for f in jsonl.CALLS:
        if f.name not in calls.columns:
            calls = calls.withColumn(f.name, F.lit(None).cast(f.dataType))
    jsonl.write_calls(calls, str(tmp_path))
    want = sorted((m, u, n) for _, m, u, n in rows if n)
    for read in (jsonl.stats_logs(spark, str(tmp_path)), jsonl.call_logs(spark, str(tmp_path))):
        got = read.collect()
        assert sorted((r.model, r.user, r.total_tokens) for r in got if r.total_tokens) == want and len(got) == 3
    assert usage.usage_total(usage.in_month(jsonl.stats_logs(spark, str(tmp_path)), "2024-02")).first().calls == 2
    path = tmp_path / "calls/plain/2024-03/2024-03-05.jsonl"
    path.parent.mkdir(parents=True)
    path.write_text('{"total_tokens": 9, "user": "u"}\n')
    assert [(r.model, r.user) for r in jsonl.call_logs(spark, str(tmp_path)).filter("total_tokens = 9").collect()] == [("plain", "u")]


def test_run_summary(spark, tmp_path):
    jsonl.write_summary(spark.createDataFrame([("kept", 3), ("dialogs", 1)], "stage string, n long"), str(tmp_path / "s"))
    text = "".join(p.read_text() for p in (tmp_path / "s").glob("part-*"))
    assert text.strip() == json.dumps({"dialogs": 1, "kept": 3}, indent=2)
