"""Registries, metadata, requests with a fake transport, sinks, the manifest, and the drop folder."""

from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest
import yaml
from pyspark.sql import functions as F

from tablesift import prompts
from tablesift.config import from_environment
from tablesift.functions import text as T
from tablesift.operators import cells as C
from tablesift.operators import gate as G
from tablesift.operators import geometry as M
from tablesift.operators import rollup as U
from tablesift.operators import rules as R
from tablesift.sources import files, metadata, ocr, registry, sinks
from tablesift.streaming import incremental

SCHEMA = {
    "format_id": "f1",
    "name": "towns",
    "description": "a test",
    "anchor_page": [{"column_no": 1, "column_name": "Serial", "variable": "sl_no", "data_type": "integer"}, {"column_no": 2, "column_name": "Town", "variable": "town_name", "value_examples": ["Agra", "Mathura"]}],
    "continuation_page": [{"column_no": 2, "column_name": "Town again", "variable": "town_name"}, {"column_no": 3, "column_name": "Wells", "variable": "wells", "data_type": "integer", "description": "count"}],
    "panels": [{"panel_id": "a", "page": 1, "printed_columns": [1, 2], "row_anchor": True}, {"panel_id": "b", "page": 2, "printed_columns": [2, 3], "align_to": "a"}],
}


def test_registry(spark, tmp_path):
    (tmp_path / "b.yaml").write_text(yaml.safe_dump(SCHEMA | {"format_id": "f2", "name": "more"}))
    (tmp_path / "a.yaml").write_text(yaml.safe_dump(SCHEMA))
    schemas = registry.load_schemas(str(tmp_path))
    assert registry.lookup(schemas, "towns") is registry.lookup(schemas, "f1")
    with pytest.raises(registry.SchemaError):
        registry.lookup(schemas, "F1")
    columns, panels = registry.frames(spark, schemas)
    assert [(r.format_id, r.column_no, r.column_name) for r in columns.orderBy("format_id", "column_no").collect()][:3] == [("f1", 1, "Serial"), ("f1", 2, "Town again"), ("f1", 3, "Wells")]
    assert registry.uncovered_columns(columns, panels).count() == 0
    assert {(r.variable, r.panel_id) for r in registry.first_panel(columns, panels).filter("format_id = 'f1'").collect()} == {("sl_no", "a"), ("town_name", "a"), ("wells", "b")}
    assert registry.export_schema(SCHEMA, ("road",)).fieldNames() == ["sl_no", "sl_no_flag", "town_name", "town_name_flag", "wells", "wells_flag", "road"]
    context = prompts.column_lines(columns).filter("format_id = 'f1'").first().context.split("\n")
    assert context[0].startswith("- 1: Serial; field sl_no; type integer") and "count" in context[2]
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(SCHEMA))
    with pytest.raises(registry.SchemaError):
        registry.load_schemas(str(tmp_path))


@pytest.mark.parametrize("change", [{"panels": []}, {"panels": SCHEMA["panels"][:1]}, {"panels": [SCHEMA["panels"][0], SCHEMA["panels"][1] | {"align_to": "z"}]}, {"panels": [SCHEMA["panels"][0] | {"align_to": "b"}, SCHEMA["panels"][1]]}, {"panels": [SCHEMA["panels"][0] | {"printed_columns": [1, 1, 2]}, SCHEMA["panels"][1]]}, {"panels": [SCHEMA["panels"][0] | {"row_anchor": False}, SCHEMA["panels"][1]]}])
def test_bad_schemas(change):
    assert registry.schema_problems(SCHEMA | change)
    assert not registry.schema_problems(SCHEMA)


def test_metadata(spark):
    raw = spark.createDataFrame([(" p1 ", "B.pdf", "f1", "3.0"), ("p2", "a.PDF", "f9", ""), ("P1", "c.pdf", "f1", None), ("p3", " ", "f1", "1")], "pdf_id string, file_name string, format_id string, anchor_page string")
    docs = metadata.documents(raw)
    assert [(r.file_name, r.anchor_page) for r in docs.collect()] == [("a.PDF", None), ("B.pdf", 3), ("c.pdf", None)]
    assert [tuple(r) for r in metadata.repeated_keys(docs).collect()] == [("pdf_id", "p1", 2)]
    hit, miss = metadata.looked_up(spark.createDataFrame([("b.PDF",), ("zz.pdf",)], "file_name string"), docs)
    assert [r.pdf_id for r in hit.collect()] == ["p1"] and [r.file_name for r in miss.collect()] == ["zz.pdf"]
    assert [r.format_id for r in metadata.format_conflicts(docs, spark.createDataFrame([("f1",)], "format_id string")).collect()] == ["f9"]
    with pytest.raises(ValueError, match="format_id"):
        metadata.documents(raw.drop("format_id"))


def test_files(spark, tmp_path):
    for n in ("b.pdf", "a.pdf", "c.txt"):
        (tmp_path / n).write_bytes(n.encode())
    assert [r.path.rsplit("/", 1)[1] for r in files.listed(spark, str(tmp_path), limit=1).collect()] == ["a.pdf"]
    assert files.digests(spark, str(tmp_path)).count() == 3


def body(text):
    return json.dumps({"choices": [{"message": {"content": text}}]})


def test_attempts():
    waits = []

    def flaky(answers):
        it = iter(answers)

        def send(payload):
            a = next(it)
            if isinstance(a, Exception):
                raise a
            return a

        return send

    assert ocr.request(flaky([(429, {"Retry-After": "0"}, ""), (200, {}, "ok")]), "p", sleep=waits.append) == ("ok", 200, 2, None)
    assert waits == [0.0]
    assert ocr.request(flaky([(400, {}, "")]), "p", sleep=waits.append) == (None, 400, 1, "HTTP 400")
    assert ocr.request(flaky([OSError("down")] * 4), "p", sleep=waits.append)[2:] == (4, "down")
    assert ocr.request(flaky([(503, {}, "")] * 4), "p", sleep=lambda s: waits.append(s))[1:3] == (503, 4)
    assert 1 <= waits[-3] < 1.3 and 2 <= waits[-2] < 2.3 and 4 <= waits[-1] < 4.3
    now = datetime(2024, 1, 1, tzinfo=timezone.utc)
    assert ocr.retry_after("Mon, 01 Jan 2024 00:00:30 GMT", now) == 30.0
    assert [ocr.retry_after(x) for x in (None, "-1", "soon", "2.5")] == [None, None, None, 2.5]
    assert ocr.has_text(body("x")) and not ocr.has_text(body(" ")) and not ocr.has_text("{}") and not ocr.has_text(None)


def test_second_run_sends_nothing(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()

    def send(payload):
        (log / payload).write_text("x")
        return (200, {}, body("t " + payload)) if payload != "bad" else (200, {}, body(""))

    requests = spark.createDataFrame([("k1", "one"), ("k2", "two"), ("k3", "bad")], "cache_key string, payload string")
    cache = str(tmp_path / "cache")
    first = {r.cache_key: (r.ok, r.cache_hit) for r in ocr.resolve(requests, cache, send).collect()}
    assert first == {"k1": (True, False), "k2": (True, False), "k3": (False, False)}
    for f in log.iterdir():
        f.unlink()
    second = {r.cache_key: (r.ok, r.cache_hit) for r in ocr.resolve(requests, cache, send).collect()}
    assert second == {"k1": (True, True), "k2": (True, True), "k3": (False, False)}
    assert {f.name for f in log.iterdir()} == {"bad"}


def test_payloads(spark):
    df = spark.createDataFrame([("Read this cell. Column: wells",), ("Something else",)], "p string")
    got = [json.loads(r.j) for r in df.select(prompts.payload(F.col("p"), "m").alias("j")).collect()]
    assert got[0]["messages"] == [{"role": "system", "content": "Column: wells"}, {"role": "user", "content": "Read this cell."}]
    assert got[1]["messages"] == [{"role": "user", "content": "Something else"}]


def small_gate(records):
    typed = C.typed_cells(C.to_long(records, (("sl_no", "integer"), ("town_name", "string"), ("wells", "integer"))))
    rows = C.classified_rows(typed)
    facts = records.groupBy("table_id").agg(F.lit(True).alias("panels_complete"), F.lit(True).alias("aligned"), F.lit(1.0).alias("geometry_min"), F.count("*").alias("ocr_ok"), F.count("*").alias("ocr_total"))
    return G.quality(typed, R.all_findings(typed, rows, C.values(typed, rows)), facts).select("table_id", "status", "overall")


RECORDS = "table_id long, row_index long, sl_no string, town_name string, wells string"
ROWS = [(1, 0, "1", "Agra", "1,200"), (1, 1, "2", "Mathura", "Nil"), (2, 0, "1", "Jhansi", "2-0"), (3, 0, "1", "Etah", "4")]


def test_export_in_three_formats(spark, tmp_path):
    records = spark.createDataFrame(ROWS, RECORDS).withColumn("nothing", F.lit(None).cast("string"))
    routed = sinks.routed(sinks.without_empty_columns(records, ["wells"]), small_gate(records))
    assert "nothing" not in routed.columns
    sinks.write_records(routed, str(tmp_path))
    for kind in ("parquet", "csv", "json"):
        reader = spark.read.option("header", True) if kind == "csv" else spark.read
        got = getattr(reader, kind)(str(tmp_path / ("jsonl" if kind == "json" else kind)))
        assert {(r.town_name, r.wells, r.area) for r in got.collect()} == {("Agra", "1,200", "clean"), ("Mathura", "Nil", "clean"), ("Jhansi", "2-0", "quarantine"), ("Etah", "4", "clean")}
    line = sinks.as_json_lines(spark.createDataFrame([(None, "é")], "b string, a string")).first().value
    assert line == '{"a":"é","b":null}'


def test_manifest(spark, tmp_path):
    one = spark.createDataFrame([("r", "p1", "ERROR", "1", "x"), ("r", "p2", "CLEAN", "1", None)], sinks.MANIFEST)
    one.write.json(str(tmp_path / "m"))
    old = sinks.read_manifest(spark, str(tmp_path / "m"))
    new = spark.createDataFrame([("r", "p1", "CLEAN", "2", None)], sinks.MANIFEST)
    merged = sinks.upsert_manifest(old, new)
    assert sorted((r.pdf_id, r.status) for r in merged.collect()) == [("p1", "CLEAN"), ("p2", "CLEAN")]
    assert {r.status: r.n for r in G.status_counts(merged).collect()} == {"CLEAN": 2, "QUARANTINED": 0, "DRY_RUN": 0, "ERROR": 0}
    assert G.exit_code(old).first().exit_code == 1 and G.exit_code(merged).first().exit_code == 0
    assert G.exit_code(merged.limit(0)).first().exit_code == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sinks.read_manifest(spark, str(tmp_path / "missing")).count()


def test_geometry_json(spark):
    bands = spark.createDataFrame([(1, 0, 1, 2, 3, 4)], "table_id long, row_index int, box_x0 int, box_y0 int, box_x1 int, box_y1 int")
    spans = spark.createDataFrame([(1, 2, 5, 6), (1, 1, 0, 5)], "table_id long, column_no int, x_start int, x_end int")
    got = json.loads(sinks.geometry_json(bands, spans).first().geometry)
    assert [c["column_no"] for c in got["columns"]] == [1, 2] and got["rows"][0]["box_y1"] == 4


def test_drops_give_the_batch_result(spark, tmp_path):
    drops = tmp_path / "drops"
    whole = spark.createDataFrame(ROWS, RECORDS)
    for part in ("table_id = 1", "table_id > 1"):
        whole.filter(part).coalesce(1).write.mode("append").parquet(str(drops))
        query = incremental.gate_drops(spark, str(drops), RECORDS, small_gate, str(tmp_path / "out"), str(tmp_path / "state"))
        query.awaitTermination()
    got = sorted(tuple(r) for r in incremental.gated(spark, str(tmp_path / "out")).select("table_id", "status", "overall").collect())
    assert got == sorted(tuple(r) for r in small_gate(whole).collect())
    assert len(list((tmp_path / "out").glob("batch=*"))) == 2


def test_command_line(tmp_path, capsys):
    from tablesift.cli import main

    (tmp_path / "a.yaml").write_text(yaml.safe_dump(SCHEMA))
    assert main(["schemas", str(tmp_path)]) == 0 and capsys.readouterr().out == "f1\n"
    (tmp_path / "a.yaml").write_text(yaml.safe_dump(SCHEMA | {"panels": []}))
    assert main(["schemas", str(tmp_path)]) == 1
    assert main(["list"]) == 0 and "gate_status" in capsys.readouterr().out


def test_trim_reports_and_dashboard(spark, tmp_path):
    ranges = spark.createDataFrame([("a", 18, 19, 20, 23, 58, 59), ("b", None, None, None, None, None, None), ("c", 5, 6, None, None, None, None)], "volume string, civic_start int, civic_end int, medical_start int, medical_end int, appendix_start int, appendix_end int")
    got = {r.volume: json.loads(r.report) for r in sinks.trim_report(ranges).collect()}
    assert got["a"] == {"civic": [18, 19], "medical": [20, 23], "appendix": [58, 59], "warnings": []}
    assert got["b"] == {"warnings": ["civic title not found"]}
    assert len(got["c"]["warnings"]) == 2
    rows = U.cleaned(spark.createDataFrame([("A", "d", "Yes", "Yes", 1971), ("B", "e", "No", None, 1971)], "state string, district string, available string, language string, year int"))
    sinks.write_dashboard(rows, U.overall(rows), U.by_state(rows), str(tmp_path))
    stats = spark.read.json(str(tmp_path / "stats")).first()
    assert stats.total == 2 and [s.state for s in stats.state_stats] == ["A", "B"]
    assert spark.read.json(str(tmp_path / "data")).count() == 2


def test_required_numbers(spark):
    good = spark.createDataFrame([("3",)], "n string")
    assert good.select(T.required_int(F.col("n"), "n").alias("v")).first().v == 3
    with pytest.raises(Exception, match="n is required"):
        spark.createDataFrame([("",)], "n string").select(T.required_int(F.col("n"), "n").alias("v")).collect()


def test_settings(monkeypatch):
    assert not from_environment().can_request
    monkeypatch.setenv("TABLESIFT_ATTEMPTS", "7")
    monkeypatch.setenv("TABLESIFT_API_KEY", "abcdefgh")
    config = from_environment().override(dpi=200, timeout_seconds=None)
    assert (config.attempts, config.dpi, config.timeout_seconds, config.can_request) == (7, 200, 90.0, True)


def test_audit_and_fallback_words(spark, tmp_path):
    records = spark.createDataFrame([("p1", "request", None), ("p2", "table", "x")], "pdf_id string, record_type string, detail string")
    sinks.write_audit(records, str(tmp_path / "audit"))
    sinks.write_audit(records, str(tmp_path / "audit"))
    assert spark.read.json(str(tmp_path / "audit")).count() == 4
    embedded = spark.createDataFrame([("a", 0, 1)], "page string, start long, stop long")
    grounded = spark.createDataFrame([("a", 5, 6), ("b", 7, 8)], "page string, start long, stop long")
    assert sorted(r.page for r in M.usable_words(embedded, grounded, ["page"]).collect()) == ["a", "b"]
    assert M.usable_words(embedded, grounded, ["page"], dry_run=True).count() == 1
