from __future__ import annotations

import base64
import json
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException

from gleanery import schemas as S
from gleanery.operators import staleness as ST
from gleanery.plans.stale_validation import stale_validation
from gleanery.plans.update import UpdateInputs, save_update, stale_page_run, update_run
from gleanery.sources.store import Store
from gleanery.sources import readers as R
from gleanery.sources import writers as W
from tests.conftest import AS_OF, by, items, overrides, rules, stale_items


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))
    return str(folder)


def test_missing_snapshot(spark, tmp_path):
    path = str(tmp_path / "none")
    assert R.read_items(spark, path, missing_ok=True).count() == 0
    with pytest.raises(AnalysisException):
        R.read_items(spark, path)
    assert R.read_stale(spark, path).schema.fieldNames() == S.STALE_ITEM.fieldNames()


def test_rules_keep_the_list_order(spark, tmp_path):
    path = put(tmp_path / "r", "rules.json", {"repos": ["b/x", "a/x"], "patterns": ["p2", "p1"]})
    rows = R.read_rules(spark, path).orderBy("kind", "pos").collect()
    assert [tuple(r) for r in rows] == [
        (0, "exact", "b/x"), (1, "exact", "a/x"), (0, "pattern", "p2"), (1, "pattern", "p1"),
    ]


def test_specs_and_overrides(spark, tmp_path):
    path = put(tmp_path / "s", "specs.json", json.dumps([{"query": "q", "maxResults": 5, "minStars": 3}, {"query": "r", "maxResults": 1, "minStars": 0}], indent=1))
    assert [tuple(r) for r in R.read_search_specs(spark, path).collect()] == [(0, "q", 5, 3), (1, "r", 1, 0)]
    path = put(tmp_path / "o", "o.json", {"pos": 0, "repo": "a/x", "tags_add": ["t"], "hidden": True})
    row = R.read_overrides(spark, path).first()
    assert (row["repo"], row["tags_add"], row["hidden"], row["name"]) == ("a/x", ["t"], True, None)


def test_landed_responses(spark, tmp_path):
    page = {"query_pos": 0, "page": 2, "total_count": 9, "items": [{"id": 1, "full_name": "a/x"}, {"id": 2, "full_name": "a/y"}]}
    hits = R.read_hits(spark, put(tmp_path / "h", "p.json", page)).collect()
    assert [(r["page"], r["hit_pos"], r["full_name"]) for r in hits] == [(2, 0, "a/x"), (2, 1, "a/y")]
    text = base64.encodebytes("Grüße\n".encode() * 30).decode()
    readmes = by(
        R.read_readmes(spark, put(tmp_path / "m", "r.json", {"full_name": "a/x", "content": text}, {"full_name": "a/y", "content": "%%"})),
        "full_name",
    )
    assert readmes["a/x"]["text"] == "Grüße\n" * 30 and readmes["a/y"]["text"] is None
    listing = {"full_name": "a/x", "path": "", "entries": [{"name": "index.hbs", "path": "index.hbs", "type": "file"}]}
    assert R.read_contents(spark, put(tmp_path / "c", "l.json", listing)).first()["name"] == "index.hbs"
    assert R.read_details(spark, put(tmp_path / "d", "d.json", {"full_name": "a/x", "topics": ["t"]})).first()["topics"] == ["t"]


def test_bytes_that_are_not_utf8_become_the_replacement_character(spark, tmp_path):
    bad = base64.b64encode(b"ok \xff\xc3 end").decode()
    rows = R.read_readmes(spark, put(tmp_path / "m", "r.json", {"full_name": "a/x", "content": bad}, {"full_name": "a/y", "content": "/w=="}))
    assert {r["full_name"]: r["text"] for r in rows.collect()} == {"a/x": "ok \ufffd\ufffd end", "a/y": "\ufffd"}
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "k.json").write_bytes(b'{"timestamp": 5, "x": "\xff"}')
    row = R.read_cache_entries(spark, str(tmp_path / "c")).first()
    assert (row["ts_ms"], row["valid"]) == (5, True) and "\ufffd" in row["payload"]


def test_cache_files(spark, tmp_path):
    folder = tmp_path / "cache"
    put(folder, "good.json", '{"data": {"x": 1}, "timestamp": 1700000000000}')
    put(folder, "bad.json", "{broken")
    put(folder, "other.txt", "{}")
    found = by(R.read_cache_entries(spark, str(folder)), "key")
    assert set(found) == {"good", "bad"}
    assert (found["good"]["ts_ms"], found["good"]["valid"], found["good"]["length"]) == (1700000000000, True, 46)
    assert (found["bad"]["ts_ms"], found["bad"]["valid"]) == (None, False)


def test_html_pages(spark, tmp_path):
    row = R.read_pages(spark, put(tmp_path / "w", "a.html", "<table>", "</table>"), fmt="html").first()
    assert row["html"] == "<table>\n</table>" and row["page_id"].endswith("a.html")


def test_versions(spark, tmp_path):
    root = str(tmp_path / "catalog")
    assert W.current_path(spark, root) is None
    W.write_items(items(spark, {"id": "1"}), root, datetime(2026, 1, 1))
    W.write_items(items(spark, {"id": "1"}, {"id": "2", "stars": 99}), root, datetime(2026, 1, 2))
    path = W.current_path(spark, root)
    assert path.endswith("v-20260102T000000")
    assert [r["id"] for r in R.read_items(spark, path).collect()] == ["2", "1"]
    with pytest.raises(ValueError, match="already committed"):
        W.write_items(items(spark, {"id": "3"}), root, datetime(2026, 1, 2))
    with pytest.raises(ValueError, match="already committed"):
        W.write_items(items(spark, {"id": "3"}), root, datetime(2026, 1, 1))
    # What is committed last is read, also with an earlier date.
    other = str(tmp_path / "other")
    W.write_items(items(spark, {"id": "1"}), other, datetime(2026, 1, 2))
    W.write_items(items(spark, {"id": "2"}), other, datetime(2026, 1, 1))
    assert W.current_path(spark, other).endswith("v-20260101T000000")
    # A version without a line in the log, as a lost job leaves it, is not current.
    items(spark, {"id": "x"}).write.parquet(W.version_path(root, "20260103T000000"))
    assert W.current_path(spark, root) == path
    W.write_items(items(spark, {"id": "y"}), root, datetime(2026, 1, 3))
    assert R.read_items(spark, W.current_path(spark, root)).first()["id"] == "y"


def test_state_is_read_per_category(spark, tmp_path):
    root = str(tmp_path / "state")
    table = stale_items(
        spark, {"id": "1", "months_stale": 20, "stale_detected_at": AS_OF},
        {"id": "2", "category": "Tool", "months_stale": 20, "stale_detected_at": AS_OF},
    )
    W.write_stale(table, root, AS_OF)
    state = R.read_stale(spark, W.current_path(spark, root))
    tools = ST.stale_by_category(state, "Tool")
    assert [r["id"] for r in tools.collect()] == ["2"]
    plan = tools._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(category" in plan
    saved = W.backup_state(spark, root, str(tmp_path / "backup"), AS_OF)
    assert spark.read.parquet(saved).count() == 2
    # A state without rows has no files; a second try keeps the backup of the first.
    W.write_stale(table.limit(0), root, datetime(2027, 1, 1))
    assert W.backup_state(spark, root, str(tmp_path / "backup"), AS_OF) == saved and spark.read.parquet(saved).count() == 2
    empty = W.backup_state(spark, root, str(tmp_path / "backup"), datetime(2027, 1, 1))
    assert R.read_stale(spark, empty).count() == 0


def test_reports_are_published_once(spark, tmp_path):
    first = W.write_report({"a": spark.range(3)}, str(tmp_path), AS_OF)
    assert W.write_report({"a": spark.range(9)}, str(tmp_path), AS_OF) == first
    assert spark.read.parquet(first["a"]).count() == 3


def run_inputs(spark, **given):
    base = dict(
        existing=items(spark, {"id": "old/kept", "score": 90, "pushed_at": datetime(2020, 1, 1)}, {"id": "old/weak", "score": 1}),
        overrides=overrides(spark), rules=rules(spark, patterns=["-test$"]), prior_stale=stale_items(spark, {}).limit(0),
    )
    return UpdateInputs(**{**base, **given})


def test_update_run_end_to_end(spark, tmp_path):
    names = ["u/theme", "u/theme-test", "u/other", "u/weak"]
    page = {
        "query_pos": 0, "page": 1, "total_count": 4,
        "items": [
            {"id": i, "name": n.split("/")[1], "full_name": n, "html_url": f"https://github.com/{n}", "stargazers_count": 50,
             "description": "A long enough description", "pushed_at": "2026-04-01T00:00:00Z", "owner": {"login": "u"}}
            for i, n in enumerate(names)
        ],
    }
    topics = {"u/theme": ["ghost-theme", "blog"], "u/theme-test": ["ghost"], "u/other": ["css"], "u/weak": ["ghost"]}
    contents = [
        ("u/theme", p, p.split("/")[-1], "dir" if "." not in p else "file")
        for p in ("index.hbs", "post.hbs", "default.hbs", "assets", "partials", "assets/a.css", "package.json")
    ]
    result = update_run(
        run_inputs(
            spark,
            hits=R.read_hits(spark, put(tmp_path / "h", "p.json", page)),
            specs=spark.createDataFrame([(0, "q", 10, 3)], S.SEARCH_SPEC),
            details=spark.createDataFrame(list(topics.items()), S.DETAIL),
            readmes=spark.createDataFrame([("u/theme", "A ghost theme. Install. Live demo."), ("u/theme-test", "ghost theme blog template install demo")], "full_name string, text string"),
            contents=spark.createDataFrame(contents, "full_name string, path string, name string, type string"),
            manifests=spark.createDataFrame([("u/theme", '{"engines":{"ghost":"5"}}')], "full_name string, json string"),
        ),
        AS_OF,
    )
    metrics = {r["metric"]: r["n"] for r in result.metrics.collect()}
    assert metrics["crawled"] == 4 and metrics["filtered_no_topic"] == 1
    assert {r["id"] for r in result.items.collect()} == {"u/theme"}
    assert {r["id"] for r in result.stale_state.collect()} == {"old/kept"}
    changes = {r["repo"]: r["type"] for r in result.changes.collect()}
    assert changes["u/theme"] == "added" and changes["old/weak"] == "removed"
    assert result.stale_summary.first()["newly_stale"] == 1

    store = Store(spark, str(tmp_path / "store"))
    assert store.read("state", S.STALE_ITEM).count() == 0
    run = save_update(result, store, AS_OF, after=0)
    assert run.number == 1 and run.metrics["crawled"] == 4
    saved = store.read("catalog", S.ITEM)
    assert [r["id"] for r in saved.collect()] == ["u/theme"]
    assert spark.read.parquet(f"{store.root}/{run.tables['reports/directory'].base}").count() == 1

    # Months later the stored theme has gone stale: the page run moves it.
    later = datetime(2027, 12, 1)
    summary = stale_page_run(store, later).first()
    assert (summary["total"], summary["newly_stale"], summary["reactivated"]) == (2, 1, 0)
    assert store.read("catalog", S.ITEM).count() == 0
    state = store.read("state", S.STALE_ITEM)
    assert state.count() == 2 and len(store.last().tables["state"].changes) == 1
    assert [r.id for r in store.read("backup", S.STALE_ITEM).collect()] == ["old/kept"]
    assert stale_validation(saved.limit(0), state, ST.stale_statistics(state)).count() == 0


def test_update_run_without_discovery(spark):
    result = update_run(run_inputs(spark), AS_OF)
    assert {r["id"] for r in result.stale_state.collect()} == {"old/kept"}
    assert result.change_stats.first().asDict() == {"added": 0, "updated": 0, "removed": 1, "ignored": 0}
