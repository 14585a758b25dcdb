"""Folders of documents, read whole and as a stream."""

from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F

from agentlake.sources import folders
from agentlake.sources.cards import read_cards
from agentlake.sources.items import BAD_JSON
from folder_files import card_folder, item_folder

KEYS = "namespace string"
EXPECTED = [
    ("dev", 0, "d0", None),
    ("dev", 1, "d1", None),
    ("dev", None, None, BAD_JSON),
    ("dev", None, None, folders.NOT_TEXT),
    ("prod", 0, "p0", None),
]


def flat(items):
    return items.select("namespace", "pos", F.try_variant_get("item", "$.name", "string").alias("name"), "reject")


def test_items_and_rejects(spark, rows, tmp_path):
    files = folders.read_documents(spark, item_folder(tmp_path), KEYS)
    assert rows(flat(folders.items_of(files, "namespace"))) == sorted(
        EXPECTED, key=lambda t: tuple((v is not None, str(v)) for v in t)
    )


def test_documents_keep_their_name_time_and_size(spark, tmp_path):
    files = {r.file_name: r for r in folders.read_documents(spark, item_folder(tmp_path), KEYS).collect()}
    good = files["pods.json"]
    assert good.size == len(good.text) and abs(good.modified.timestamp() - time.time()) < 7 * 86_400
    assert files["cut.json"].text.startswith("{") and files["latin.json"].text is None
    assert "none.json" not in files and "notes.txt" not in files


def test_filters_reach_the_folders(spark, tmp_path, capsys):
    files = folders.read_documents(spark, item_folder(tmp_path), KEYS)
    picked = files.filter("namespace = 'prod' and size < 1000000")
    picked.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(namespace" in plan and "(namespace#" in plan.split("PartitionFilters")[1]
    assert "LessThan(length,1000000)" in plan
    assert {r.namespace for r in picked.collect()} == {"prod"}


def test_cards_are_those_of_the_plain_reader(spark, rows, tmp_path):
    path = card_folder(tmp_path)
    cards = folders.cards_of(folders.read_documents(spark, path))
    assert rows(cards, "card_uri", "agent_card") == rows(read_cards(spark, path), "card_uri", "agent_card")


@pytest.mark.parametrize("files_per_batch", [1, 100])
def test_only_new_files_are_read(spark, rows, tmp_path, files_per_batch):
    path, table = item_folder(tmp_path), str(tmp_path / "table")
    stream = lambda: folders.items_of(folders.stream_documents(spark, path, KEYS, files_per_batch=files_per_batch), "namespace")
    batch = lambda: folders.items_of(folders.read_documents(spark, path, KEYS), "namespace")
    assert rows(flat(folders.append_new(stream(), table))) == rows(flat(batch()))
    # A file that was read is not read again, whatever became of it.
    late = tmp_path / "items" / "namespace=stage"
    late.mkdir()
    (late / "new.json").write_text(json.dumps({"items": [{"name": "s0"}]}))
    got = rows(flat(folders.append_new(stream(), table)))
    assert got == rows(flat(batch())) and ("stage", 0, "s0", None) in got
    assert rows(flat(folders.append_new(stream(), table))) == got


def test_empty_folder(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert folders.items_of(folders.read_documents(spark, str(tmp_path / "none"), KEYS), "namespace").count() == 0
