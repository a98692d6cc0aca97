"""Detectors on small frames, quantiles against numpy, planted outliers."""

from __future__ import annotations

from datetime import datetime

import numpy as np
import pytest

from lakevault.operators import anomaly
from lakevault.operators.quantiles import exact_quantiles

AT = datetime(2024, 1, 1)


def clicks(spark, values):
    return spark.createDataFrame(
        [("A", "1B", i, 1, 1, v) for i, v in enumerate(values)],
        "code_module string, code_presentation string, id_student long, id_site long, date long, "
        "sum_click long")


def scores(spark, values):
    return spark.createDataFrame([(1, i, v) for i, v in enumerate(values)],
                                 "id_assessment long, id_student long, score double")


def test_no_spread_gives_no_z_flags(spark):
    assert anomaly.click_anomalies(clicks(spark, [5] * 20), AT).count() == 0
    row = anomaly.click_anomalies(clicks(spark, [6000] * 3), AT).first()
    assert (row.anomaly_reason, row.anomaly_score) == ("exceeds_daily_max_5000", 1.2)


def test_empty_frame_and_missing_column(spark):
    assert anomaly.click_anomalies(clicks(spark, [1]).limit(0), AT).count() == 0
    assert anomaly.click_anomalies(spark.range(3), AT).count() == 0
    assert anomaly.score_anomalies(scores(spark, [1.0]).limit(0), AT).count() == 0
    assert anomaly.score_anomalies(spark.range(3), AT).count() == 0


def test_cap_reason_wins_over_z(spark):
    rows = anomaly.click_anomalies(clicks(spark, [1] * 50 + [9000]), AT).collect()
    assert [(r.anomaly_reason, r.anomaly_score) for r in rows] == [("exceeds_daily_max_5000", 1.8)]


def test_arguments_win_over_config(spark):
    df = clicks(spark, [1] * 50 + [9000])
    config = {"click_threshold": {"daily_max": 10000, "z_score": 2.5}}
    assert anomaly.click_anomalies(df, AT, config=config).first().anomaly_reason == \
        "z_score_exceeds_2.5"
    assert anomaly.click_anomalies(df, AT, daily_max=100, config=config).first().anomaly_reason \
        == "exceeds_daily_max_100"


def test_score_reasons(spark):
    values = [50.0 + i % 11 for i in range(200)]
    rows = anomaly.score_anomalies(scores(spark, [*values, 500.0, 76.0, 34.0]), AT).collect()
    reasons = {r.score: r.anomaly_reason for r in rows}
    q1, q3 = np.quantile([*values, 500.0, 76.0, 34.0], [0.25, 0.75])
    high, low = q3 + 1.5 * (q3 - q1), q1 - 1.5 * (q3 - q1)
    assert reasons == {500.0: "z_score_exceeds_3.0", 76.0: f"above_upper_fence_{high:.1f}",
                       34.0: f"below_lower_fence_{low:.1f}"}


def test_missing_score_counts_as_zero_for_z_only(spark):
    rows = anomaly.score_anomalies(scores(spark, [80.0 + i % 3 for i in range(60)] + [None]), AT)
    assert [(r.score, r.anomaly_reason) for r in rows.collect()] == [(None, "z_score_exceeds_3.0")]


@pytest.mark.parametrize("seed,size", [(1, 1), (2, 2), (3, 777), (4, 5000)])
def test_quantiles_match_numpy(spark, seed, size):
    values = np.random.default_rng(seed).normal(50, 20, size).round(seed).tolist()
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    df = scores(spark, [*values, None])
    row = spark.range(1).select(exact_quantiles(df, "score", probs).alias("q")).first().q
    assert np.allclose(list(row), np.quantile(values, probs), rtol=0, atol=1e-9)


def test_quantiles_with_a_far_outlier(spark):
    values = [float(i % 100) for i in range(3000)] + [1e12]
    df = scores(spark, values)
    row = spark.range(1).select(exact_quantiles(df, "score", [0.25, 0.75]).alias("q")).first().q
    assert list(row) == np.quantile(values, [0.25, 0.75]).tolist()


def registration(spark, rows):
    return spark.createDataFrame(
        rows, "code_module string, code_presentation string, id_student long, "
              "date_registration long, date_unregistration double")


def test_temporal_checks(spark):
    reg = registration(spark, [("A", "1B", 0, 2, 0.0), ("B", "1B", 0, -9, 5.0),
                               ("A", "1B", 1, 0, 0.5), ("A", "1B", 2, -400, None)])
    df = clicks(spark, [1, 1, 1])
    assert [r.id_student for r in anomaly.vle_before_registration(df, reg).collect()] == [0]
    assert [r.id_student for r in anomaly.activity_after_unregistration(df, reg).collect()] == [1]
    assert [r.date_registration for r in anomaly.outside_registration_window(reg)
            .orderBy("id_student").collect()] == [2, -400]


def test_assessment_check_and_its_count_agree(spark):
    reg = registration(spark, [("A", "1B", 1, 10, None), ("B", "1B", 1, 20, None),
                               ("A", "1B", 2, 0, None)])
    subs = spark.createDataFrame(
        [(1, 1, 5, 0, 1.0), (2, 1, 15, 0, 1.0), (3, 1, 30, 0, 1.0), (4, 2, 5, 0, 1.0),
         (5, 1, None, 0, 1.0)],
        "id_assessment long, id_student long, date_submitted long, is_banked long, score double")
    rows = anomaly.assessment_before_registration(subs, reg)
    assert rows.count() == anomaly.assessment_before_counts(subs, reg).first()["count"] == 3
    meta = spark.createDataFrame(
        [(1, "A", "1B", "Exam"), (2, "A", "1B", "TMA"), (4, "A", "1B", "Exam")],
        "id_assessment long, code_module string, code_presentation string, assessment_type string")
    strict = anomaly.assessment_before_registration_strict(subs, meta, reg)
    assert [r.id_assessment for r in strict.collect()] == [1]
    lazy = anomaly.zero_activity_exam(subs, meta, clicks(spark, [1, 20]))
    assert [(r.id_assessment, r.total_clicks) for r in lazy.collect()] == [(4, 0)]


def test_planted_outliers_are_found(spark):
    """Bursts of thousands of clicks and impossible marks; a global z-score masks milder ones."""
    rng = np.random.default_rng(7)
    normal = rng.poisson(20, 5000).tolist()
    planted = [int(x) for x in rng.integers(3000, 9000, 40)]
    found = anomaly.click_anomalies(clicks(spark, normal + planted), AT).filter(
        "id_student >= 5000").count()
    assert found / len(planted) >= 0.9
    marks = np.clip(rng.normal(65, 8, 5000), 30, 100).round(1).tolist()
    wrong = rng.uniform(400, 900, 40).round(1).tolist()
    found = anomaly.score_anomalies(scores(spark, marks + wrong), AT).filter(
        "id_student >= 5000").count()
    assert found / len(wrong) >= 0.9


def test_totals_leave_temporal_counts_out(spark):
    reg = registration(spark, [("A", "1B", i, 9, None) for i in range(3)])
    subs = spark.createDataFrame(
        [(1, 0, 5, 0, 1.0)],
        "id_assessment long, id_student long, date_submitted long, is_banked long, score double")
    df = clicks(spark, [1, 1, 9000])
    counts = anomaly.summary(AT, df, subs, reg)
    assert {r.anomaly_type: r["count"] for r in counts.collect()} == {
        "click_outlier": 1, "score_outlier": 0, "vle_before_registration": 3,
        "assessment_before_registration": 1}
    assert anomaly.total(counts).first().anomalies_found == 1
    flags = anomaly.detect_all(AT, df, subs, reg)
    assert flags.count() == 5
    assert flags.filter("anomaly_type = 'click_outlier'").first().keys == \
        '{"id_student":2,"id_site":1,"date":1}'
    assert anomaly.samples(flags).count() == 1
    with pytest.raises(ValueError):
        anomaly.detect_all(AT)
