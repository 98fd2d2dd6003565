"""The preparation, rule, segment and anomaly studies on a small table of raw loans."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orebed.config import BAD_STATUSES, MiningConfig
from orebed.plans import studies
from orebed.plans.preparation import prepare
from orebed.session import cut_lineage
from orebed.sources import readers, sinks


@pytest.fixture(scope="module")
def loans(spark):
    rng = np.random.default_rng(11)
    n = 1200
    fico = rng.normal(700, 40, n).round()
    grade = np.clip((780 - fico) // 25, 0, 6).astype(int)
    rows = []
    for i in range(n):
        rows.append((
            i, f"u{i}", float(rng.integers(1000, 40000)), f" {36 if rng.random() < 0.7 else 60} months",
            f"{6 + grade[i] * 2 + rng.random():.2f}%", "ABCDEFG"[grade[i]], "ABCDEFG"[grade[i]] + str(i % 5 + 1),
            ["< 1 year", "3 years", "10+ years", None][i % 4], ["RENT", "OWN", "MORTGAGE"][i % 3],
            float(np.exp(rng.normal(11, 0.6))), ["Verified", "Not Verified"][i % 2], ["car", "house", "card"][i % 3], "CA",
            float(fico[i]), float(fico[i] + 4), float(rng.gamma(2, 9)), f"{rng.random() * 100:.1f}%",
            float(rng.integers(5, 40)), None if rng.random() < 0.1 else float(rng.integers(0, 6)),
            None if rng.random() < 0.5 else float(rng.integers(1, 80)), "w" if rng.random() < 0.5 else "f",
            "Joint App" if rng.random() < 0.05 else "Individual", None if rng.random() < 0.9 else 1.0,
            float(rng.random()), 1, "Dec-2015", ["Fully Paid", "Charged Off", "Current", None][0 if rng.random() < 0.7 else i % 4],
        ))
    names = (
        "row_id bigint, id string, loan_amnt double, term string, int_rate string, grade string, sub_grade string, emp_length string, "
        "home_ownership string, annual_inc double, verification_status string, purpose string, addr_state string, fico_range_low double, "
        "fico_range_high double, dti double, revol_util string, total_acc double, mort_acc double, mths_since_last_delinq double, "
        "initial_list_status string, application_type string, annual_inc_joint double, recoveries double, policy_code int, issue_d string, loan_status string"
    )
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="module")
def prepared(loans):
    return prepare(cut_lineage(loans), MiningConfig())


def test_preparation(loans, prepared):
    labelled = loans.where("loan_status is not null").count()
    for name in ("cleaned", "original", "scaled", "pca", "plane", "basket", "label"):
        assert prepared[name].count() == labelled
    features = prepared["features"]
    assert features[:3] == ["grade", "annual_inc", "dti"] and len(features) <= 12
    assert "fico_range_high" not in features  # equal to fico_range_low up to a constant
    gone = {"id", "issue_d", "recoveries", "policy_code", "annual_inc_joint", "application_type", "addr_state"}
    assert not gone & set(features)
    scaled = prepared["scaled"].agg(*[F.avg(c) for c in features], *[F.stddev_pop(c) for c in features]).first()
    assert np.allclose(scaled[: len(features)], 0, atol=1e-9) and np.allclose(scaled[len(features):], 1)
    nulls = prepared["cleaned"].agg(*[F.count_if(F.col(c).isNull()) for c in features]).first()
    assert sum(nulls) == 0
    fit = prepared["components"]
    assert np.cumsum(fit.ratios)[len(prepared["pca"].columns) - 2] >= 0.90


def test_rule_study(prepared):
    items = studies.domain_items(prepared["original"], prepared["basket"])
    assert {"grade", "purpose", "int_rate", "home"} <= set(items.columns)
    out = studies.mine_rules(items)
    stats = out["stats"].first()
    assert stats["n_before"] > stats["n_after"] > 0 and stats["min_lift"] > 1.15


def test_segment_and_anomaly_studies(prepared):
    seg = studies.segment(
        prepared["pca"], prepared["original"], prepared["label"], ["annual_inc", "dti"],
        F.col("loan_status").isin(*BAD_STATUSES), n_init=2,
    )
    profile = seg["profile"].collect()
    assert {r["segment"] for r in profile} == {"Prime", "Higher-risk"}
    assert sum(r["size_pct"] for r in profile) == pytest.approx(100, abs=0.2)
    feats = [c for c in prepared["features"] if c != "grade"]
    found = studies.flag_anomalies(
        prepared["original"], feats, (F.col("annual_inc") > 1e6) | (F.col("dti") > 100), ["dti", "revol_util"], trees=20,
    )
    n = found.agg(F.min("n_methods"), F.max("n_methods"), F.count_if("confirmed"), F.count("classification"), F.count("outlier_type")).first()
    assert 0 <= n[0] <= n[1] <= 4 and n[2] == n[3] == n[4]


def test_sources_and_sinks(spark, prepared, tmp_path):
    path = str(tmp_path / "out")
    written = sinks.save_outputs({"label": prepared["label"]}, path, "csv")
    back = readers.read_table(spark, written["label"], "csv", all_string=True)
    assert back.count() == prepared["label"].count() and dict(back.dtypes)["row_id"] == "string"
    typed = readers.read_table(spark, written["label"], "csv", nrows=5, order_by="row_id")
    assert typed.count() == 5 and dict(typed.dtypes)["row_id"] == "int"
    missing, real = readers.read_optional(spark, path + "/none")
    assert missing is None and not real
    narrow = readers.narrow_types(spark.range(300).selectExpr("id", "id % 100 AS small", "id / 7.0D AS d"))
    assert dict(narrow.dtypes) == {"id": "smallint", "small": "tinyint", "d": "float"}
