from conftest import SF_SMALL

from forecourt import queries, staging
from forecourt.sources.views import view


def test_stages_on_a_view_stay_below_what_the_jvm_compiles(spark):
    for name in ("listings", "listings_dirty", "predictions", "listings_priced"):
        spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
        view(spark, SF_SMALL, name)
        assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_a_run_and_its_rerun_look_at_the_predictions_once(spark, monkeypatch):
    looked, once = [], queries._once
    monkeypatch.setattr(queries, "_once", lambda *args, **more: looked.append(args[2]) or once(*args, **more))
    assert queries.QUERIES["history_merge"](spark, SF_SMALL).count() == 1
    assert looked == ["predictions"]


def test_a_refreshed_baseline_is_copied_once_for_each_champion(spark, monkeypatch):
    copies, copy = [], staging._copy
    monkeypatch.setattr(staging, "_copy", lambda df: copies.append(df.columns) or copy(df))
    queries.QUERIES["baseline_refresh"](spark, SF_SMALL)
    assert len(copies) == 2


def test_the_profiled_baseline_is_written_once_and_its_window_not_at_all(spark, monkeypatch):
    copies, copy = [], staging._copy
    monkeypatch.setattr(staging, "_copy", lambda df: copies.append(df.columns) or copy(df))
    assert queries.QUERIES["profile_drift"](spark, SF_SMALL).count() == 10
    assert not copies
