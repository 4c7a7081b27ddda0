import os
import subprocess
import sys

import pytest

from carryover.config import parse_config
from conftest import ROOT

FIX = os.path.join(ROOT, "tests", "fixtures")

BASE = {
    "source": {"type": "hive", "database": "shop", "hive": {"metastore_uri": "thrift://h:9083"}},
    "target": {"catalog_type": "hadoop", "catalog_name": "iceberg", "database": "shop", "hadoop": {"warehouse": "/wh"}},
    "tables": ["shop.yellow_tripdata", "shop.green_tripdata"],
    "migration": {"write_mode": "create", "repartition": None, "partition_by": []},
}


def test_reference_layout_parses():
    cfg = parse_config(BASE)
    assert cfg.options.catalog == "iceberg" and cfg.options.fmt == "iceberg"
    assert cfg.settings["spark.sql.catalog.iceberg.type"] == "hadoop"
    assert cfg.settings["spark.sql.catalogImplementation"] == "hive"
    assert cfg.tables == ("shop.yellow_tripdata", "shop.green_tripdata")


@pytest.mark.parametrize(
    "patch,match",
    [
        ({"target": {"catalog_type": "nessie"}}, "target.nessie block"),
        ({"target": {"catalog_type": "bogus"}}, "catalog_type"),
        ({"source": {"type": "hive"}}, "metastore_uri"),
        ({"migration": {"write_mode": "upsert"}}, "unknown write mode"),
        (
            {
                "target": {"catalog_type": "s3_tables", "s3_tables": {"warehouse": "arn:x"}},
                "migration": {"write_mode": "register"},
            },
            "cannot register",
        ),
    ],
)
def test_bad_configs_fail_clearly(patch, match):
    raw = {**BASE, **patch}
    with pytest.raises(ValueError, match=match):
        parse_config(raw)


def _run(*args):
    env = dict(os.environ, PYTHONPATH=ROOT)
    return subprocess.run(
        [sys.executable, "-m", "carryover", *args], capture_output=True, text=True, env=env, cwd=ROOT, timeout=300
    )


def _config_with_own_warehouse(tmp_path):
    import yaml

    raw = yaml.safe_load(open(os.path.join(FIX, "session.yaml")))
    raw["spark"]["extra_config"]["spark.sql.warehouse.dir"] = str(tmp_path / "warehouse")
    path = tmp_path / "session.yaml"
    path.write_text(yaml.safe_dump(raw))
    return str(path)


def test_cli_migrate_then_checks_in_one_session(tmp_path):
    out = _run("migrate", "-c", _config_with_own_warehouse(tmp_path), "-t", "/root/testdata/sf0.001/orders.parquet,,/root/testdata/sf0.001/customer.parquet", "-q", os.path.join(FIX, "checks-copy.sql"))
    assert out.returncode == 0, out.stdout + out.stderr[-2000:]
    assert "tables: 2 ok, 0 not ok" in out.stdout
    assert "checks: 4 passed, 0 failed" in out.stdout


def test_cli_verify_missing_file_fails(tmp_path):
    out = _run("verify", "-c", _config_with_own_warehouse(tmp_path), "-q", os.path.join(FIX, "nope.sql"))
    assert out.returncode == 1
    assert "not found" in out.stdout


def test_cli_register_flow(spark, tmp_path, scratch):
    """Stage raw ds= trees, then register them through the CLI and run the register checks."""
    import yaml

    from carryover.plans import stage_exports

    root = scratch("raw")
    per_ds = stage_exports(
        spark,
        {"events": "/root/testdata/sf0.001/events.parquet", "orders": "/root/testdata/sf0.001/orders.parquet"},
        root,
        max_rows=0,
    ).collect()
    assert len(per_ds) == 4
    raw = {
        "source": {"type": "parquet"},
        "target": {"catalog_type": "session", "database": "raw_reg"},
        "spark": {
            "master": "local[2]",
            "extra_config": {"spark.ui.enabled": "false", "spark.sql.warehouse.dir": str(tmp_path / "wh")},
        },
        "tables": [f"{root}/events", f"{root}/orders"],
        "migration": {"write_mode": "register", "register_partition_columns": ["ds"]},
    }
    cfg = tmp_path / "register.yaml"
    cfg.write_text(yaml.safe_dump(raw))
    out = _run("migrate", "-c", str(cfg), "-q", os.path.join(FIX, "checks-register.sql"))
    assert out.returncode == 0, out.stdout + out.stderr[-2000:]
    assert "tables: 2 ok, 0 not ok" in out.stdout
    assert "checks: 2 passed, 0 failed" in out.stdout


def test_cli_migrate_with_missing_check_file_writes_nothing(tmp_path):
    out = _run("migrate", "-c", _config_with_own_warehouse(tmp_path), "-q", os.path.join(FIX, "nope.sql"))
    assert out.returncode == 1 and "not found" in out.stdout
    assert not (tmp_path / "warehouse").exists()


def test_scratch_folder_fallback_without_checkpoint_dir(tmp_path):
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from carryover.session import local_session, scratch_root\n"
        "s = local_session(1)\n"
        "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
        "a = scratch_root(s); b = scratch_root(s)\n"
        "print('ROOTS', a, b)\n"
    ) % ROOT
    conf_dir = tmp_path / "no-defaults"  # no spark-defaults.conf, so no checkpoint folder is configured
    conf_dir.mkdir()
    env = dict(os.environ, SPARK_CONF_DIR=str(conf_dir))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, env=env)
    assert out.returncode == 0, out.stderr[-2000:]
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("ROOTS")][0]
    a, b = line.split()[1:]
    assert "carryover-" in a and b.replace("file:", "").startswith(a.replace("file:", ""))


def test_cli_validate(tmp_path):
    ok = _run("validate", "-c", os.path.join(FIX, "session.yaml"))
    assert ok.returncode == 0 and "valid: source=parquet catalog=session" in ok.stdout
    bad = tmp_path / "bad.yaml"
    bad.write_text("source: {type: hive}\ntarget: {catalog_type: hadoop}\n")
    out = _run("validate", "-c", str(bad))
    assert out.returncode == 1 and "invalid:" in out.stdout


def test_cli_stage_export(tmp_path, scratch):
    root = scratch("cli-stage")
    out = _run("stage-export", "--root", root, "--rows", "100", "--master", "local[2]",
               "orders=/root/testdata/sf0.001/orders.parquet")
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.count("100") >= 2


def test_cli_validate_reports_broken_yaml(tmp_path):
    bad = tmp_path / "broken.yaml"
    bad.write_text("source: [unclosed\n")
    out = _run("validate", "-c", str(bad))
    assert out.returncode == 1 and "invalid:" in out.stdout


def test_config_flags_tables_and_nulls():
    raw = {
        "source": {"type": "parquet", "merge_schema": "false"},
        "target": {"catalog_type": "session", "database": None},
        "storage": {"endpoint": "http://m:9000", "path_style_access": "false"},
        "tables": ["a"],
    }
    cfg = parse_config(raw)
    assert cfg.source.merge_schema is False and cfg.options.database == "default"
    assert cfg.settings["spark.hadoop.fs.s3a.path.style.access"] == "false"
    with pytest.raises(ValueError, match="must be a list"):
        parse_config({**raw, "tables": "orders"})
    with pytest.raises(ValueError, match="yes/no"):
        parse_config({**raw, "storage": {"endpoint": "x", "path_style_access": "maybe"}})
    with pytest.raises(ValueError, match="extra_config"):
        parse_config({**raw, "spark": {"extra_config": ["a"]}})


def test_cli_migrate_json_report(tmp_path):
    import json

    out = _run("migrate", "-c", _config_with_own_warehouse(tmp_path), "-t", "/root/testdata/sf0.001/region.parquet", "--json")
    assert out.returncode == 0, out.stderr[-2000:]
    rows = [json.loads(line) for line in out.stdout.splitlines() if line.startswith("{")]
    assert rows == [
        {
            "kind": "table",
            "source": "/root/testdata/sf0.001/region.parquet",
            "target": "`spark_catalog`.`shop_copy`.`region`",
            "mode": "create",
            "source_rows": 5,
            "target_rows": 5,
            "added_rows": 5,
            "status": "success",
            "error": None,
        }
    ]


def test_migration_options_reach_the_run():
    raw = {
        "source": {"type": "hive", "metastore_uri": "thrift://h:9083"},  # the flat layout
        "target": {"catalog_type": "session", "database": "d"},
        "migration": {
            "write_mode": "replace", "staged_replace": False, "cluster": "none", "scheduler_pool": "etl",
            "writer_options": {"maxRecordsPerFile": 1000}, "targets": {"sales.2024": "sales_2024"},
        },
    }
    cfg = parse_config(raw)
    o = cfg.options
    assert (o.staged_replace, o.cluster, dict(o.writer_options)) == (False, "none", {"maxRecordsPerFile": "1000"})
    assert dict(cfg.targets) == {"sales.2024": "sales_2024"} and cfg.pool == "etl"
    assert parse_config(raw | {"migration": {}}).options.staged_replace is True
    with pytest.raises(ValueError, match="stagedreplace"):
        parse_config(raw | {"migration": {"stagedreplace": True}})
    with pytest.raises(ValueError, match="cluster"):
        parse_config(raw | {"migration": {"cluster": "hash"}})


def test_staging_commands_take_metastore_and_storage_settings(monkeypatch):
    from carryover import cli

    seen = {}

    def stop_here(settings, **kw):
        seen.update(settings)
        raise SystemExit(0)

    monkeypatch.setattr(cli, "build_session", stop_here)
    for command in (["stage-tables", "--database", "d"], ["stage-export", "--root", "s3a://raw"]):
        seen.clear()
        with pytest.raises(SystemExit):
            cli.main([*command, "a=/x.parquet", "--metastore-uri", "thrift://h:9083", "--endpoint", "http://s:9000", "--access-key", "k"])
        assert seen["spark.hadoop.hive.metastore.uris"] == "thrift://h:9083"
        assert seen["spark.hadoop.fs.s3a.endpoint"] == "http://s:9000" and seen["spark.hadoop.fs.s3a.access.key"] == "k"
