"""Lines of stored files that are rows, and those that are not, each with its reason."""

import json

import pytest
from pyspark.sql import functions as F

from newsquake.schemas import ROW, ROW_FIELDS
from newsquake.sources import sinks, stored

LINES = [
    ('{"ticker": "A", "news": "one\\ntwo é"}', None),
    ('  {"ticker": "B"}\t', None),
    ('{"ticker": "", "task": "x", "other": {"a": [1]}}', None),
    ('{"ticker": 7}', None),
    ("", "blank"),
    (" \t ", "blank"),
    ('{"ticker": "C", "news": "cut', "broken_json"),
    ('{"ticker": "C"', "broken_json"),
    ('{"ticker": "C"} trailing', "broken_json"),
    ('{"ticker": "C"}, {"ticker": "D"}', "broken_json"),
    ('{"ticker": "C"} {"ticker": "D"}', "broken_json"),
    ('{"ticker": "C"}],[{"ticker": "D"}', "broken_json"),
    ("nothing like it", "broken_json"),
    ("{'ticker': 'C'}", "broken_json"),
    ('{"ticker": 01}', "broken_json"),
    ("{", "broken_json"),
    ("{}", "missing ticker"),
    ('{"ticker": null, "news": "n"}', "missing ticker"),
    ('{"news": "n"}', "missing ticker"),
    ('[{"ticker": "E"}]', "no_object"),
    ('"text"', "no_object"),
    ("12.5", "no_object"),
    ("null", "no_object"),
    ("true", "no_object"),
    ('[{"ticker": "E"}', "broken_json"),
    ('"text', "broken_json"),
]


@pytest.fixture
def path(tmp_path):
    (tmp_path / "rows.jsonl").write_text("\n".join(line for line, _ in LINES) + "\n", encoding="utf-8")
    return str(tmp_path / "rows.jsonl")


def test_every_line_has_its_verdict(spark, path):
    lines = stored.read_lines(spark, path)
    got = {r.line.strip(): r.reject_reason for r in lines.collect()}
    assert got == {line.strip(): reason for line, reason in LINES if reason != "blank"}
    assert all((r.row is None) == (r.reject_reason is not None) and r.file.endswith("rows.jsonl") for r in lines.collect())
    for line, reason in LINES:  # the strict parser of the language accepts what is no broken line
        try:
            json.loads(line)
            assert reason != "broken_json"
        except ValueError:
            assert reason in ("broken_json", "blank")


def test_counts_and_reject_table(spark, path, tmp_path):
    lines = stored.read_lines(spark, path)
    counts = {r.outcome: r.n for r in stored.line_counts(lines).collect()}
    assert counts == {"row": 4, "broken_json": 12, "missing ticker": 3, "no_object": 5}
    sinks.write_rejects(lines, str(tmp_path / "rejects"))
    kept = spark.read.json(str(tmp_path / "rejects"))
    assert kept.count() == 20 and {r.reject_reason for r in kept.collect()} == set(counts) - {"row"}
    assert kept.where(F.col("line") == "{").first().reject_reason == "broken_json"


def test_rows_raise_or_leave(spark, path, tmp_path):
    with pytest.raises(Exception, match="rejected line in"):
        stored.read_rows(spark, path).collect()
    with pytest.raises(Exception, match="rejected line in"):
        stored.read_rows(spark, path).count()
    left = stored.read_rows(spark, path, on_reject="leave")
    assert left.columns == list(ROW_FIELDS) and sorted(r.ticker for r in left.collect()) == ["", "7", "A", "B"]
    assert {r.ticker: r.news for r in left.collect()}["A"] == "one\ntwo é" and left.where("task is null").count() == 0
    with pytest.raises(ValueError, match="on_reject"):
        stored.read_rows(spark, path, on_reject="drop")


def test_the_five_lines_of_a_damaged_file(spark, tmp_path):
    (tmp_path / "five.jsonl").write_text('{"ticker": "A"}\nbroken\n\n{}\n{"ticker": "B", "ne')
    lines = stored.read_lines(spark, str(tmp_path / "five.jsonl"))
    assert {r.outcome: r.n for r in stored.line_counts(lines).collect()} == {"row": 1, "broken_json": 2, "missing ticker": 1}
    assert [r.ticker for r in stored.read_rows(spark, str(tmp_path / "five.jsonl"), on_reject="leave").collect()] == ["A"]


def test_other_schemas_and_empty_files(spark, tmp_path):
    (tmp_path / "none.jsonl").write_text("")
    assert stored.read_rows(spark, str(tmp_path / "none.jsonl")).count() == 0
    (tmp_path / "n.jsonl").write_text('{"id": 1, "ok": true}\n{"id": 2}\n')
    schema = "id bigint, ok boolean, name string"
    rows = stored.read_rows(spark, str(tmp_path / "n.jsonl"), spark.createDataFrame([], schema).schema)
    assert sorted(map(tuple, rows.collect())) == [(1, True, ""), (2, None, "")]
    (tmp_path / "crlf.jsonl").write_bytes(b'{"ticker": "A"}\r\n{"ticker": "B"}\r\n')
    assert stored.read_rows(spark, str(tmp_path / "crlf.jsonl"), ROW).count() == 2
