"""Nothing of a raw file is lost: broken lines and unknown fields come back as they were."""

from __future__ import annotations

import json

from verdigris.schemas import RAW_COLUMNS
from verdigris.sources.rescue import rescue_csv, rescue_json, route_rescued

FULL = ["1", "2023-11-26 10:00:00", "6.0", "900", "1", "22", "55", "20", "ON", "OFF", "OFF", "ON", "OFF"]


def test_csv_lines_of_the_wrong_length(spark, tmp_path, fresh):
    lines = [",".join(RAW_COLUMNS), ",".join(FULL), ",".join(FULL) + ",extra", ",".join(FULL[:3]), ',"a ""b"" ü",' + ",".join(FULL[2:])]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    rows = rescue_csv(spark, str(tmp_path))
    quarantine = fresh()
    good = route_rescued(rows, quarantine)
    assert {(r.id, r.timestamp) for r in good.collect()} == {("1", FULL[1]), (None, 'a "b" ü')}
    kept = spark.read.parquet(quarantine).collect()
    assert sorted(r._rescued for r in kept) == sorted(lines[2:4])
    assert {r._file for r in kept} == {"a.csv"}


def test_json_lines(spark, tmp_path, fresh):
    bare = {"id": "1", "pH": 6.5}
    lines = [
        json.dumps(bare),
        json.dumps(bare | {"firmware": "v2", "nested": {"a": [1]}}),
        json.dumps({"records": [{"id": "2"}, {"id": "3", "odd": "x"}], "sender": "s"}),
        '{"id": "4", "pH": ',
        '["no object"]',
        '{"records": "no list"}',
        "",
        json.dumps({"records": []}),
        '{"id": null}',
    ]
    (tmp_path / "a.json").write_text("\n".join(lines), encoding="utf-8")
    quarantine = fresh()
    good = route_rescued(rescue_json(spark, str(tmp_path)), quarantine).collect()
    found = sorted(((r.id, json.loads(r._rescued) if r._rescued else None) for r in good), key=str)
    assert found == sorted(
        [
            ("1", None),
            ("1", {"firmware": "v2", "nested": '{"a":[1]}'}),
            ("2", {"sender": "s"}),
            ("3", {"sender": "s", "odd": "x"}),
            (None, None),
        ],
        key=str,
    )
    assert sorted(r._rescued for r in spark.read.parquet(quarantine).collect()) == sorted(lines[3:6])


def test_json_documents_of_several_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"records": [{"id": "1", "new": "y"}]}, indent=1))
    (tmp_path / "b.json").write_text('{"id":\n')
    rows = {r._file: (r.id, r._rescued, r._broken) for r in rescue_json(spark, str(tmp_path), multi_line=True).collect()}
    assert rows == {"a.json": ("1", '{"new":"y"}', False), "b.json": (None, '{"id":\n', True)}


def test_no_files_with_rows(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n\n")
    assert rescue_json(spark, str(tmp_path)).count() == 0
