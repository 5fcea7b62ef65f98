"""Broken documents are never lost: they fail the read or land in the quarantine."""

from __future__ import annotations

import json
import os

import pytest

from pricecube.sources import cube, documents
from pricecube.streaming.landing import load_landed, quarantine

DOC = {
    "id": ["geo", "time"], "size": [1, 2],
    "dimension": {"geo": {"category": {"index": {"DE": 0}, "label": {"DE": "Germany"}}},
                  "time": {"category": {"index": {"2016-S1": 0, "2016-S2": 1}, "label": {"2016-S1": "a, \"b\" {c}"}}}},
    "value": {"0": 0.5, "1": 1},
}
LINE, PRETTY = json.dumps(DOC), json.dumps(DOC, indent=2)


def without(key):
    return json.dumps({k: v for k, v in DOC.items() if k != key})


def with_(**changed):
    return json.dumps(DOC | changed)


BROKEN = {
    "cut": (LINE[: len(LINE) // 2], "not one JSON object"),
    "cut_pretty": (PRETTY[: len(PRETTY) // 2], "not one JSON object"),
    "cut_end": (LINE[:-1], "not one JSON object"),
    "trailing": (LINE + " and more", "not one JSON object"),
    "page": ("<html>busy</html>", "not one JSON object"),
    "list": ("[" + LINE + "]", "not one JSON object"),
    "number": ("1", "not one JSON object"),
    "null": ("null", "not one JSON object"),
    "two": (LINE + "," + LINE, "not one JSON object"),
    "blank": (" \n", "not one JSON object"),
    "no_id": (without("id"), "no dimension ids"),
    "id_text": (with_(id="geo"), "no dimension ids"),
    "no_size": (without("size"), "no sizes"),
    "sizes": (with_(size=[1]), "as many sizes as ids are needed"),
    "zero": (with_(size=[0, 2]), "a size below one"),
    "no_dimension": (without("dimension"), "a dimension without categories"),
    "one_dimension": (with_(id=["geo", "unit"]), "a dimension without categories"),
    "text_cell": (with_(value={"0": "n/a"}), "cells that are not numbers"),
    "cell_list": (with_(value=[1, 2]), "cells that are not numbers"),
    "cell_index": (with_(value={"x": 1}), "a cell whose index is not a number"),
}
WHOLE = {"line": LINE, "pretty": PRETTY, "two_lines": LINE + "\n\n" + LINE + "\r\n", "no_cells": without("value"), "null_cells": with_(value=None)}


def land(path, **files):
    os.makedirs(f"{path}/dataset=nrg_pc_204", exist_ok=True)
    for name, text in files.items():
        with open(f"{path}/dataset=nrg_pc_204/{name}.json", "w", newline="") as f:
            f.write(text)


def name(row):
    return os.path.basename(row.path).removesuffix(".json")


def test_whole_documents_in_any_layout(spark, tmp_dir):
    land(tmp_dir, **WHOLE)
    docs = cube.read_cube_json(spark, tmp_dir)
    assert docs.columns == ["doc", "dataset"] and docs.count() == 6
    got = cube.decode(docs, value_col="v")
    assert got.count() == 8 and {r.time_label for r in got.collect()} == {'a, "b" {c}', ""}


@pytest.mark.parametrize("case", BROKEN)
def test_reading_a_broken_document_fails_with_its_path(spark, tmp_dir, case):
    land(tmp_dir, good=LINE, **{case: BROKEN[case][0]})
    with pytest.raises(Exception, match=f"{case}.json: {BROKEN[case][1]}"):
        cube.decode(cube.read_cube_json(spark, tmp_dir), ["geo", "time"]).collect()


def test_quarantine_in_the_pass_that_stores_whole_documents(spark, tmp_dir):
    land(f"{tmp_dir}/in", **WHOLE, **{k: t for k, (t, _) in BROKEN.items()}, mixed=LINE + "\n" + LINE[:40] + "\n" + LINE)
    whole, broken = documents.store_documents(documents.read_documents(spark, f"{tmp_dir}/in"), f"{tmp_dir}/store")
    assert sorted(name(r) for r in whole.collect()) == sorted([*WHOLE, "two_lines", "mixed", "mixed"])
    got = {name(r): (r.text, r.reason) for r in broken.collect()}
    assert got.pop("mixed") == (LINE[:40], "not one JSON object")
    assert got == BROKEN
    assert broken.where("dataset = 'nrg_pc_204'").count() == len(BROKEN) + 1
    with pytest.raises(documents.BrokenDocumentsError, match="blank.json"):
        documents.fail_on(broken)
    documents.fail_on(broken.limit(0))


def test_lines_layout_splits_files(spark, tmp_dir):
    land(tmp_dir, many="\n".join([LINE] * 50 + [LINE[:-2]] + [LINE] * 50))
    found = documents.read_documents(spark, tmp_dir, "lines")
    assert found.where("reason is null").count() == 100
    assert [r.text for r in found.where("reason is not null").collect()] == [LINE[:-2]]
    with pytest.raises(ValueError):
        documents.read_documents(spark, tmp_dir, "pages")


def test_stream_quarantines_and_goes_on(spark, tmp_dir):
    landing, target = f"{tmp_dir}/landing", f"{tmp_dir}/raw"
    land(landing, pretty=PRETTY, cut=BROKEN["cut"][0])
    rows = load_landed(spark, landing, target, f"{tmp_dir}/ckpt", dims=["geo", "time"])
    assert rows.count() == 2
    lost = quarantine(spark, f"{target}_documents")
    assert [(name(r), r.reason, r.text, r.dataset, r.run) for r in lost.collect()] == [("cut", BROKEN["cut"][1], BROKEN["cut"][0], "nrg_pc_204", 1)]
    land(landing, trailing=BROKEN["trailing"][0], line=LINE)
    assert load_landed(spark, landing, target, f"{tmp_dir}/ckpt", dims=["geo", "time"]).count() == 4
    assert sorted((name(r), r.run) for r in quarantine(spark, f"{target}_documents").collect()) == [("cut", 1), ("trailing", 2)]


def test_stream_fails_before_a_row_is_loaded(spark, tmp_dir):
    landing, target = f"{tmp_dir}/landing", f"{tmp_dir}/raw"
    land(landing, line=LINE, cut=BROKEN["cut"][0])
    for _ in range(2):  # until the caller accepts the quarantine
        with pytest.raises(documents.BrokenDocumentsError, match="cut.json"):
            load_landed(spark, landing, target, f"{tmp_dir}/ckpt", on_broken="fail")
        assert not os.path.exists(target)
    assert load_landed(spark, landing, target, f"{tmp_dir}/ckpt").count() == 2
    assert load_landed(spark, landing, target, f"{tmp_dir}/ckpt", on_broken="fail").count() == 2
    with pytest.raises(ValueError):
        load_landed(spark, landing, target, on_broken="ignore")


def test_a_run_reads_only_its_own_documents(spark, tmp_dir, monkeypatch):
    landing, target, seen = f"{tmp_dir}/landing", f"{tmp_dir}/raw", []
    asked = cube.document_dims
    monkeypatch.setattr(cube, "document_dims", lambda docs, *a: (seen.append({name(r) for r in docs.select("path").collect()}), asked(docs, *a))[1])
    land(landing, a=LINE)
    load_landed(spark, landing, target, f"{tmp_dir}/ckpt")
    land(landing, b=PRETTY)
    load_landed(spark, landing, target, f"{tmp_dir}/ckpt")
    assert load_landed(spark, landing, target, f"{tmp_dir}/ckpt").count() == 4
    assert seen == [{"a"}, {"b"}, set()]
