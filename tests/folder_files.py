"""Folders of files that tests read."""

from __future__ import annotations

import json

from test_sources import card_folder  # noqa: F401


def item_folder(tmp_path) -> str:
    folder = tmp_path / "items"
    for namespace in ("dev", "prod"):
        (folder / f"namespace={namespace}").mkdir(parents=True)
    dev, prod = folder / "namespace=dev", folder / "namespace=prod"
    (dev / "pods.json").write_text(json.dumps({"items": [{"name": "d0"}, {"name": "d1"}]}))
    (dev / "cut.json").write_text('{"items": [{"name": "lost"')
    (dev / "latin.json").write_bytes(b'{"items": "\xff\xfe"}')
    (dev / "notes.txt").write_text("{}")
    (dev / "bare.JSON").write_text('{"kind": "List"}')
    (prod / "pods.Json").write_text(json.dumps({"items": [{"name": "p0"}]}))
    (prod / "none.json").write_text("")
    return str(folder)
