"""The command line in its own process (its own Spark application)."""
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _cli(*args):
    return subprocess.run(
        [sys.executable, "-m", "strata", *args], cwd=ROOT, capture_output=True, text=True, timeout=600
    )


def test_gate_and_validate_exit_codes(spark, store):
    for t in ["products", "customers", "exchange_rates", "orders", "order_items"]:
        store.replace("silver", t, spark.range(100).selectExpr("id AS k"))
    store.replace("quarantine", "orders", spark.range(5).selectExpr("id AS k"))
    gate = _cli("gate", "--store", store.root)
    assert gate.returncode == 2 and "orders: 4.76%" in gate.stderr
    store.replace("quarantine", "orders", spark.range(0).selectExpr("id AS k"))
    assert _cli("gate", "--store", store.root).returncode == 0
    validate = _cli("validate", "--store", store.root)
    assert validate.returncode == 2 and "daily_sales: missing" in validate.stderr


def _silver_rows(store):
    return {t: store.read("silver", t).count() for t in ("orders", "order_items")}


def test_one_mart_and_one_table_can_be_rebuilt_alone(spark, store):
    from conftest import SF_SMALL
    from strata.plans.lake_sources import lake_config, lake_sources
    from strata.plans.pipeline import run_pipeline

    import datetime as dt

    run_pipeline(spark, store, lake_sources(SF_SMALL), lake_config(dt.datetime(2002, 1, 1), gate=False))
    before = {m: store.current_path("gold", m) for m in ("daily_sales", "customer_360")}
    want = store.read("gold", "customer_360").drop("_gold_computed_at").collect()
    r = _cli("gold", "--store", store.root, "customer_360", "--as-of", "2001-12-31")
    assert r.returncode == 0, r.stderr[-2000:]
    assert store.current_path("gold", "daily_sales") == before["daily_sales"]
    assert store.current_path("gold", "customer_360") != before["customer_360"]
    again = store.read("gold", "customer_360").drop("_gold_computed_at").collect()
    assert sorted(map(str, again)) == sorted(map(str, want))

    r = _cli("silver", "--store", store.root, "orders", "--as-of", "2001-12-31")
    assert r.returncode == 0 and '"orders"' in r.stdout and "order_items" not in r.stdout
    config = store.root + "/pipeline.json"
    with open(config, "w") as fh:
        fh.write('{"pipeline": {"thresholds": {"orders": 100, "order_items": 100, "products": 100}}}')
    assert _cli("gate", "--store", store.root).returncode == 2
    assert _cli("gate", "--store", store.root, "--config", config).returncode == 0
    r = _cli("sql", "--store", store.root, "SELECT count(*) AS n FROM silver_orders WHERE _month >= '1900'")
    assert str(store.read("silver", "orders").count()) in r.stdout
    assert _cli("gold", "--store", store.root, "no_such_mart").returncode != 0


def test_launcher_settings_win(tmp_path):
    code = (
        "from strata.session import get_session\n"
        "s = get_session(conf={'spark.sql.shuffle.partitions': '3'})\n"
        "print('GOT', *[s.conf.get(k) for k in ('spark.sql.session.timeZone', 'spark.sql.ansi.enabled',"
        " 'spark.sql.adaptive.skewJoin.enabled', 'spark.sql.shuffle.partitions', 'spark.sql.adaptive.enabled')])\n"
    )
    env = os.environ | {
        "PYTHONPATH": ROOT,
        "PYSPARK_SUBMIT_ARGS": "--master local[1] --conf spark.sql.session.timeZone=Asia/Tokyo --conf spark.sql.ansi.enabled=false "
        "--conf spark.sql.adaptive.skewJoin.enabled=false --conf spark.sql.shuffle.partitions=77 pyspark-shell",
    }
    r = subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "GOT Asia/Tokyo false false 3 true" in r.stdout, r.stderr[-2000:]


def test_a_cluster_needs_a_shared_checkpoint_folder():
    import pytest

    from strata.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())
