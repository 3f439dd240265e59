"""DuckDB twin of the registered queries (the correctness oracle).

Independent SQL text over the raw parquet views: it repeats the rules of
``plans.incidents`` and the operator definitions, not the Spark code paths.
Types are cast to what Spark returns (INTEGER / BIGINT / DOUBLE / VARCHAR).
"""

from __future__ import annotations

D = "CAST({} AS DOUBLE)".format

INCIDENTS = f"""
incidents AS (
  SELECT e.event_id AS ID,
    CAST(CASE e.event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3
         WHEN 'purchase' THEN 3 WHEN 'error' THEN 4 END AS INTEGER) AS Severity,
    e.ts AS Start_Time,
    e.ts + to_seconds(CAST(floor(e.value * 60) AS BIGINT) - 600) AS End_Time,
    n.n_name AS State,
    {D('23.9')} + (e.event_id % 4850) / {D('100.0')} AS Start_Lat,
    {D('-170.5')} + CAST(e.user_id % 105 AS DOUBLE) AS Start_Lng,
    CASE WHEN e.event_id % 10 = 0 THEN NULL ELSE e.value - {D('10.0')} END AS Temperature_F,
    CASE WHEN e.event_id % 10 = 0 THEN NULL ELSE e.value - {D('10.0')} END
      - CAST(e.user_id % 7 AS DOUBLE) AS Wind_Chill_F,
    CASE WHEN e.event_id % 20 = 3 THEN NULL ELSE CAST(e.user_id % 100 AS DOUBLE) END AS Humidity_Pct,
    {D('29.0')} + (e.event_id % 200) / {D('100.0')} AS Pressure_in,
    CAST(json_extract_string(e.props, '$.k') AS DOUBLE) / {D('10.0')} AS Visibility_mi,
    CASE WHEN e.event_id % 10 = 5 THEN NULL ELSE CAST(e.event_id % 50 AS DOUBLE) END AS Wind_Speed_mph,
    CASE WHEN e.event_id % 3 = 0 THEN NULL ELSE (e.event_id % 100) / {D('100.0')} END AS Precipitation_in,
    e.value / {D('100.0')} AS Distance_mi,
    CASE e.event_id % 5 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Cloudy' WHEN 2 THEN 'Rain'
         WHEN 3 THEN 'Snow' END AS Weather_Condition,
    CASE e.user_id % 5 WHEN 0 THEN 'N' WHEN 1 THEN 'E' WHEN 2 THEN 'S' WHEN 3 THEN 'W' END AS Wind_Direction,
    CASE WHEN e.event_id % 25 = 7 THEN NULL WHEN hour(e.ts) BETWEEN 6 AND 17 THEN 'Day'
         ELSE 'Night' END AS Sunrise_Sunset,
    CASE WHEN hour(e.ts) BETWEEN 5 AND 18 THEN 'Day' ELSE 'Night' END AS Civil_Twilight,
    CASE WHEN e.event_id % 40 = 9 THEN NULL ELSE
      CASE e.user_id % 4 WHEN 0 THEN 'US/Eastern' WHEN 1 THEN 'US/Central' WHEN 2 THEN 'US/Mountain'
           ELSE 'US/Pacific' END END AS Timezone,
    e.user_id % 13 = 0 AS Amenity, e.user_id % 17 = 0 AS Bump, e.user_id % 3 = 0 AS Crossing,
    e.user_id % 19 = 0 AS Give_Way,
    CASE WHEN e.event_id % 50 = 1 THEN NULL ELSE e.user_id % 2 = 0 END AS Junction,
    e.user_id % 23 = 0 AS No_Exit, e.user_id % 11 = 0 AS Railway, e.user_id % 29 = 0 AS Roundabout,
    e.user_id % 31 = 0 AS Station, e.user_id % 7 = 0 AS Stop, e.user_id % 37 = 0 AS Traffic_Calming,
    e.user_id % 5 = 0 AS Traffic_Signal, e.user_id % 41 = 0 AS Turning_Loop
  FROM events e
  LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

LOOKUP = """
lookup AS (
  SELECT n.n_name AS State, r.r_name AS Region,
         'Zone_' || CAST(n.n_nationkey % 4 AS VARCHAR) AS Climate_Zone
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE r.r_name <> 'MIDDLE EAST')"""

ENRICHED = """
enriched AS (
  SELECT i.*, l.Region, l.Climate_Zone FROM incidents i LEFT JOIN lookup l ON i.State = l.State)"""

_DUR = (f"round((floor(epoch(End_Time)) - floor(epoch(Start_Time))) / {D('60.0')}, 2)")

FEATURED = f"""
featured AS (
  SELECT *,
    CAST(hour(Start_Time) AS INTEGER) AS Hour,
    CAST(dayofweek(Start_Time) + 1 AS INTEGER) AS DayOfWeek,
    CAST(month(Start_Time) AS INTEGER) AS Month,
    CAST(year(Start_Time) AS INTEGER) AS Year,
    CASE WHEN {_DUR} < 0 THEN {D('0.0')} WHEN {_DUR} > 1440 THEN {D('1440.0')} ELSE {_DUR} END AS Duration_Min,
    CASE WHEN (hour(Start_Time) BETWEEN 7 AND 9) OR (hour(Start_Time) BETWEEN 16 AND 19)
         THEN 1 ELSE 0 END AS Is_Peak_Hour,
    CASE WHEN dayofweek(Start_Time) + 1 IN (1, 7) THEN 1 ELSE 0 END AS Is_Weekend,
    CASE WHEN Temperature_F < 20 OR Temperature_F > 100 THEN 2
         WHEN Temperature_F >= 20 AND Temperature_F < 40 THEN 1 ELSE 0 END AS Temp_Risk,
    CASE WHEN Visibility_mi < 2.0 THEN 1 ELSE 0 END AS Low_Visibility,
    CASE WHEN Distance_mi < 0.1 THEN 0 WHEN Distance_mi < 0.5 THEN 1 WHEN Distance_mi < 1.0 THEN 2
         ELSE 3 END AS Distance_Bucket,
    CASE WHEN Sunrise_Sunset = 'Night' THEN 1 ELSE 0 END AS Is_Night,
    (CASE WHEN Junction THEN 1 ELSE 0 END) + (CASE WHEN Crossing THEN 1 ELSE 0 END)
      + (CASE WHEN Traffic_Signal THEN 1 ELSE 0 END) + (CASE WHEN Stop THEN 1 ELSE 0 END)
      + (CASE WHEN Railway THEN 1 ELSE 0 END) AS Infra_Risk_Score
  FROM enriched)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BASE = with_ctes(INCIDENTS)
ENR = with_ctes(INCIDENTS, LOOKUP, ENRICHED)
FEAT = with_ctes(INCIDENTS, LOOKUP, ENRICHED, FEATURED)

NUMERIC = ("Temperature_F", "Wind_Chill_F", "Humidity_Pct", "Pressure_in", "Visibility_mi",
           "Wind_Speed_mph", "Precipitation_in", "Distance_mi")
ENRICHED_COLUMNS = ("ID", "Severity", "Start_Time", "End_Time", "State", "Start_Lat", "Start_Lng",
                    "Temperature_F", "Wind_Chill_F", "Humidity_Pct", "Pressure_in", "Visibility_mi",
                    "Wind_Speed_mph", "Precipitation_in", "Distance_mi", "Weather_Condition",
                    "Wind_Direction", "Sunrise_Sunset", "Civil_Twilight", "Timezone", "Amenity",
                    "Bump", "Crossing", "Give_Way", "Junction", "No_Exit", "Railway", "Roundabout",
                    "Station", "Stop", "Traffic_Calming", "Traffic_Signal", "Turning_Loop",
                    "Region", "Climate_Zone")


def _union_long(template: str, cols) -> str:
    return "\nUNION ALL\n".join(template.format(c=c) for c in cols)


ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["flagship_region_hour"] = FEAT + """
SELECT Region, Hour, count(*) AS incidents, CAST(sum(Is_Peak_Hour) AS BIGINT) AS peak_incidents,
  CAST(sum(Is_Weekend) AS BIGINT) AS weekend_incidents, round(avg(Severity), 6) AS avg_severity
FROM featured GROUP BY Region, Hour ORDER BY Region NULLS LAST, Hour"""

ORACLE_SQL["s04_parquet_scan"] = BASE + "SELECT * FROM incidents"
ORACLE_SQL["s07_state_lookup"] = with_ctes(LOOKUP) + "SELECT * FROM lookup"

ORACLE_SQL["v01_shape"] = BASE + """
SELECT count(*) AS rows, CAST(33 AS INTEGER) AS columns FROM incidents"""

_CRIT = ("Severity", "Start_Time", "Start_Lat", "Start_Lng", "State")
ORACLE_SQL["v02_null_report"] = BASE + "SELECT * FROM (" + _union_long(
    "SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    "round(count(*) FILTER (WHERE {c} IS NULL) * 100.0e0 / count(*), 4) AS null_pct, "
    "CASE WHEN round(count(*) FILTER (WHERE {c} IS NULL) * 100.0e0 / count(*), 4) < 5.0 "
    "THEN 'PASS' ELSE 'WARN' END AS status FROM incidents", _CRIT) + ")"

ORACLE_SQL["v03_domain_check"] = BASE + """
SELECT 'Severity' AS column, count(*) FILTER (WHERE NOT Severity IN (1, 2, 3, 4)) AS violations,
  CASE WHEN count(*) FILTER (WHERE NOT Severity IN (1, 2, 3, 4)) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM incidents"""

ORACLE_SQL["v04_range_check"] = BASE + """
SELECT count(*) FILTER (WHERE Start_Lat < 24.0 OR Start_Lat > 72.0 OR Start_Lng < -170.0
                           OR Start_Lng > -66.0) AS violations,
  count(*) AS rows,
  CASE WHEN count(*) FILTER (WHERE Start_Lat < 24.0 OR Start_Lat > 72.0 OR Start_Lng < -170.0
                                OR Start_Lng > -66.0) < count(*) * 0.01e0 THEN 'PASS' ELSE 'WARN' END AS status
FROM incidents"""

ORACLE_SQL["v05_class_distribution"] = BASE + """
SELECT Severity, count(*) AS count FROM incidents GROUP BY Severity ORDER BY Severity"""

ORACLE_SQL["v06_missing_report"] = ENR + "SELECT * FROM (" + _union_long(
    "SELECT '{c}' AS column, round(count(*) FILTER (WHERE {c} IS NULL) * 100.0e0 / count(*), 2) "
    "AS missing_pct FROM enriched", ENRICHED_COLUMNS) + ") WHERE missing_pct > 0 ORDER BY missing_pct DESC, \"column\""

ORACLE_SQL["v07_describe_numeric"] = BASE + "SELECT * FROM (" + _union_long(
    "SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 6) AS mean, "
    "round(stddev_samp({c}), 6) AS stddev, round(min({c}), 6) AS min, round(max({c}), 6) AS max "
    "FROM incidents", NUMERIC) + ")"

_PROBS = (0.05, 0.25, 0.5, 0.75, 0.95)
ORACLE_SQL["v08_quantiles"] = BASE + "SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, CAST({p} AS DOUBLE) AS prob, quantile_disc({c}, {p}) AS value FROM incidents"
    for c in NUMERIC for p in _PROBS) + ")"

ORACLE_SQL["v09_all_null_columns"] = ENR + "SELECT * FROM (" + _union_long(
    "SELECT '{c}' AS column, count({c}) AS non_null, count({c}) = 0 AS all_null FROM enriched",
    ENRICHED_COLUMNS) + ")"

ORACLE_SQL["v10_histogram"] = BASE + """
, b AS (SELECT min(Temperature_F) AS lo, max(Temperature_F) AS hi FROM incidents),
x AS (SELECT Severity, Temperature_F AS t,
        CAST(least(CASE WHEN (hi - lo) / 30.0e0 > 0 THEN floor((Temperature_F - lo) / ((hi - lo) / 30.0e0))
                        ELSE 0 END, 29) AS INTEGER) AS bin
      FROM incidents, b WHERE Temperature_F IS NOT NULL)
SELECT Severity, bin, count(*) AS count, min(t) AS bin_min, max(t) AS bin_max
FROM x GROUP BY Severity, bin ORDER BY Severity, bin"""

ORACLE_SQL["v11_box_stats"] = BASE + """
SELECT Severity, min(Visibility_mi) AS min, quantile_disc(Visibility_mi, 0.25) AS q1,
  quantile_disc(Visibility_mi, 0.5) AS median, quantile_disc(Visibility_mi, 0.75) AS q3,
  max(Visibility_mi) AS max
FROM incidents GROUP BY Severity ORDER BY Severity"""

ORACLE_SQL["v12_count_by_hour"] = BASE + """
SELECT CAST(hour(Start_Time) AS INTEGER) AS Hour, count(*) AS count FROM incidents GROUP BY 1 ORDER BY 1"""

ORACLE_SQL["v13_top_states"] = BASE + """
SELECT coalesce(State, 'Unknown') AS State, count FROM (
  SELECT State, count(*) AS count FROM incidents GROUP BY State
  ORDER BY count DESC, State ASC NULLS LAST LIMIT 10)"""

ORACLE_SQL["v13_top_weather"] = BASE + """
SELECT coalesce(Weather_Condition, 'Unknown') AS Weather_Condition, count FROM (
  SELECT Weather_Condition, count(*) AS count FROM incidents GROUP BY Weather_Condition
  ORDER BY count DESC, Weather_Condition ASC NULLS LAST LIMIT 10)"""

_BOUNDS = (("Hour", 0, 23), ("DayOfWeek", 1, 7), ("Month", 1, 12), ("Duration_Min", 0, 1440),
           ("Temp_Risk", 0, 2), ("Distance_Bucket", 0, 3), ("Infra_Risk_Score", 0, 5))
ORACLE_SQL["v15_feature_bounds"] = FEAT + "SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
    f"CAST({lo} AS DOUBLE) AS lo, CAST({hi} AS DOUBLE) AS hi, "
    f"coalesce(min({c}) >= {lo} AND max({c}) <= {hi}, true) AS within FROM featured"
    for c, lo, hi in _BOUNDS) + ")"

ORACLE_SQL["h01_incident_features"] = FEAT + """
SELECT ID, Hour, DayOfWeek, Month, Year, Duration_Min, Is_Peak_Hour, Is_Weekend, Temp_Risk,
  Low_Visibility, Distance_Bucket, Is_Night, Infra_Risk_Score FROM featured"""

ORACLE_SQL["j01_enrich"] = ENR + "SELECT * FROM enriched"

# ---- projections -------------------------------------------------------------

PREDS = f"""
preds AS (
  SELECT ID, Start_Time, State, CAST(Severity - 1 AS DOUBLE) AS label,
    CAST(CASE WHEN Distance_mi < 0.15 THEN 0 WHEN Distance_mi < 0.35 THEN 1
              WHEN Distance_mi < 0.90 THEN 2 ELSE 3 END AS DOUBLE) AS pred_a,
    CAST(CASE WHEN ID % 3 = 0 THEN 1 ELSE 2 END AS DOUBLE) AS pred_b,
    Distance_mi AS score,
    {D(1)} / ({D(1)} + abs(Distance_mi * {D(100)} - {D(5)})) AS score_0,
    {D(1)} / ({D(1)} + abs(Distance_mi * {D(100)} - {D(25)})) AS score_1,
    {D(1)} / ({D(1)} + abs(Distance_mi * {D(100)} - {D(60)})) AS score_2,
    {D(1)} / ({D(1)} + abs(Distance_mi * {D(100)} - {D(200)})) AS score_3
  FROM incidents)"""
PRED = with_ctes(INCIDENTS, PREDS)

_FLAGS = ("Amenity", "Bump", "Crossing", "Give_Way", "Junction", "No_Exit", "Railway", "Roundabout",
          "Station", "Stop", "Traffic_Calming", "Traffic_Signal", "Turning_Loop")
ORACLE_SQL["p03_bools_to_int"] = BASE + "SELECT ID, " + ", ".join(
    f"CAST({c} AS INTEGER) AS {c}" for c in _FLAGS) + " FROM incidents"

ORACLE_SQL["p04_labels"] = PRED + """
SELECT ID, label, CASE WHEN label >= 2 THEN 1.0e0 ELSE 0.0e0 END AS binary_label, pred_a,
  round(score, 4) AS Score, CAST(label = pred_a AS INTEGER) AS Correct,
  pred_a + 1 AS Predicted_Severity, label + 1 AS Actual_Severity
FROM preds"""

# ---- sampling ------------------------------------------------------------------

_U = "(CAST(('0x' || substr(md5('42:' || CAST(ID AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0e0)"
_SPLIT = (f"CASE WHEN {_U} < 0.7e0 THEN 'train' WHEN {_U} < (0.7e0 + 0.15e0) THEN 'valid' "
          "ELSE 'test' END")
_US = _U.replace("'42:'", "'sample:42:'")        # samples hash another text than splits
IDS = "SELECT ID, Start_Time, Severity FROM incidents"

ORACLE_SQL["g01_sample_fraction"] = BASE + IDS + f" WHERE {_US} < 0.1e0"
ORACLE_SQL["g02_sample_cap"] = BASE + IDS + f" ORDER BY {_US}, ID LIMIT 1000"
ORACLE_SQL["g01_sample_of_train"] = BASE + IDS + f" WHERE {_SPLIT} = 'train' AND {_US} < 0.2e0"
ORACLE_SQL["g01_sample_of_test"] = BASE + IDS + f" WHERE {_SPLIT} = 'test' AND {_US} < 0.5e0"
ORACLE_SQL["g02_cap_of_test"] = BASE + IDS + f" WHERE {_SPLIT} = 'test' ORDER BY {_US}, ID LIMIT 100"
ORACLE_SQL["j03_overlap_of_samples"] = BASE + f"SELECT ID FROM incidents WHERE {_SPLIT} = 'train' AND {_US} < 0.1e0"
ORACLE_SQL["g03_split"] = BASE + f"SELECT ID, {_SPLIT} AS split FROM incidents"
ORACLE_SQL["g04_temporal_split"] = BASE + """
SELECT ID, CASE WHEN Start_Time < TIMESTAMP '2024-01-22 00:00:00' THEN 'train'
                WHEN Start_Time < TIMESTAMP '2024-01-26 00:00:00' THEN 'valid' ELSE 'test' END AS split
FROM incidents"""
ORACLE_SQL["g05_split_summary"] = BASE + f"""
SELECT split, count(*) AS rows, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM (SELECT {_SPLIT} AS split FROM incidents) GROUP BY split ORDER BY split"""
ORACLE_SQL["g06_repartition_by_state"] = BASE + "SELECT * FROM incidents"
ORACLE_SQL["g07_round_robin"] = BASE + "SELECT * FROM incidents"

# ---- evaluation ----------------------------------------------------------------


def _class_tables(src: str) -> str:
    """CTEs cnt / t / per over a (model, label, prediction) source."""
    return f"""
, cnt AS (SELECT model, label, prediction, count(*) AS c FROM ({src}) GROUP BY ALL),
sup AS (SELECT model, label AS cls, sum(c) AS support,
          sum(CASE WHEN label = prediction THEN c ELSE 0 END) AS tp FROM cnt GROUP BY ALL),
prd AS (SELECT model, prediction AS cls, sum(c) AS predicted FROM cnt GROUP BY ALL),
t AS (SELECT coalesce(s.model, p.model) AS model, coalesce(s.cls, p.cls) AS cls,
        CAST(coalesce(tp, 0) AS BIGINT) AS tp, CAST(coalesce(predicted, 0) AS BIGINT) AS predicted,
        CAST(coalesce(support, 0) AS BIGINT) AS support
      FROM sup s FULL JOIN prd p ON s.model = p.model AND s.cls = p.cls),
per AS (SELECT model, cls, support, tp,
          coalesce(tp * 1.0e0 / nullif(predicted, 0), 0.0e0) AS p,
          coalesce(tp * 1.0e0 / nullif(support, 0), 0.0e0) AS r,
          coalesce(2.0e0 * tp / nullif(predicted + support, 0), 0.0e0) AS f FROM t)
"""


_A = "SELECT 'm' AS model, label, pred_a AS prediction FROM preds"
_AB = ("SELECT 'rule_a' AS model, label, pred_a AS prediction FROM preds UNION ALL "
       "SELECT 'rule_b' AS model, label, pred_b AS prediction FROM preds")
_METRICS = """
SELECT model, round(coalesce(sum(tp) * 1.0e0 / nullif(sum(support), 0), 0), 6) AS accuracy,
  round(coalesce(sum(f * support) / nullif(sum(support), 0), 0), 6) AS f1,
  round(coalesce(sum(p * support) / nullif(sum(support), 0), 0), 6) AS precision,
  round(coalesce(sum(r * support) / nullif(sum(support), 0), 0), 6) AS recall
FROM per GROUP BY model"""

ORACLE_SQL["m01_accuracy"] = PRED + """
SELECT round(avg(CASE WHEN label = pred_a THEN 1.0e0 ELSE 0.0e0 END), 6) AS accuracy FROM preds"""
ORACLE_SQL["m02_weighted_f1"] = PRED + _class_tables(_A) + f"SELECT f1 FROM ({_METRICS})"
ORACLE_SQL["m03_weighted_pr"] = PRED + _class_tables(_A) + f"SELECT precision, recall FROM ({_METRICS})"
ORACLE_SQL["m04_evaluate_all"] = PRED + _class_tables(_AB) + _METRICS
ORACLE_SQL["m14_best_model"] = PRED + _class_tables(_AB) + f"""
SELECT model AS best_model, f1 AS best_f1 FROM ({_METRICS}) ORDER BY f1 DESC, model LIMIT 1"""

_CONF = """
, cnt AS (SELECT label, pred_a AS prediction, count(*) AS c FROM preds GROUP BY ALL),
cls AS (SELECT label AS c FROM cnt UNION SELECT prediction FROM cnt),
cm AS (SELECT a.c AS label, b.c AS prediction, CAST(coalesce(cnt.c, 0) AS BIGINT) AS count
       FROM cls a CROSS JOIN cls b LEFT JOIN cnt ON cnt.label = a.c AND cnt.prediction = b.c)
"""
ORACLE_SQL["m05_confusion"] = PRED + _CONF + "SELECT * FROM cm ORDER BY label, prediction"
ORACLE_SQL["m06_confusion_norm"] = PRED + _CONF + """
SELECT label, prediction, count,
  round(coalesce(count * 1.0e0 / nullif(sum(count) OVER (PARTITION BY label), 0), 0), 6) AS rate
FROM cm ORDER BY label, prediction"""

ORACLE_SQL["m07_class_report"] = PRED + _class_tables(_A) + """
, pc AS (SELECT CAST(cls AS VARCHAR) AS class, p AS precision, r AS recall, f AS f1, support FROM per)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM pc
UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
  CAST(sum(support) AS BIGINT) FROM pc
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
  CAST(sum(support) AS BIGINT) FROM pc"""

_OVR = " UNION ALL ".join(
    f"SELECT '{k}' AS class, score_{k} AS score, CASE WHEN label = {k} THEN 1 ELSE 0 END AS pos FROM preds"
    for k in range(4))
_BIN = "SELECT 'binary' AS class, score, CASE WHEN label >= 2 THEN 1 ELSE 0 END AS pos FROM preds"


def _curve(src: str) -> str:
    return f"""
, g AS (SELECT class, score, CAST(sum(pos) AS BIGINT) AS p, CAST(sum(1 - pos) AS BIGINT) AS n
        FROM ({src}) GROUP BY class, score),
c AS (SELECT *, sum(p) OVER w AS cum_p, sum(n) OVER w AS cum_n,
        sum(p) OVER (PARTITION BY class) AS pos_total, sum(n) OVER (PARTITION BY class) AS neg_total
      FROM g WINDOW w AS (PARTITION BY class ORDER BY score DESC
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""


ORACLE_SQL["m08_roc_curve"] = PRED + _curve(_OVR) + """
SELECT class, score AS threshold, round(coalesce(cum_n * 1.0e0 / nullif(neg_total, 0), 0), 6) AS fpr,
  round(coalesce(cum_p * 1.0e0 / nullif(pos_total, 0), 0), 6) AS tpr FROM c
UNION ALL SELECT DISTINCT class, CAST(NULL AS DOUBLE), 0.0e0, 0.0e0 FROM g"""

_AUC = """
SELECT class, round(coalesce(sum(n * (cum_p - p / 2.0e0)) / nullif(max(pos_total) * 1.0e0 * max(neg_total), 0), 0), 6) AS auc
FROM c GROUP BY class"""
ORACLE_SQL["m09_roc_auc"] = (PRED + _curve(_OVR) + _AUC + "\nUNION ALL\n"
                             + "SELECT * FROM (" + "WITH " + INCIDENTS + "," + PREDS
                             + _curve(_BIN) + _AUC + ")")

ORACLE_SQL["m10_pr_curve"] = PRED + _curve(_OVR) + """
SELECT class, score AS threshold,
  round(coalesce(cum_p * 1.0e0 / nullif(cum_p + cum_n, 0), 0), 6) AS precision,
  round(coalesce(cum_p * 1.0e0 / nullif(pos_total, 0), 0), 6) AS recall FROM c
UNION ALL SELECT DISTINCT class, CAST(NULL AS DOUBLE), 1.0e0, 0.0e0 FROM g"""

ORACLE_SQL["m11_avg_precision"] = PRED + _curve(_OVR) + """
SELECT class, round(sum(coalesce(p * 1.0e0 / nullif(pos_total, 0), 0)
                        * coalesce(cum_p * 1.0e0 / nullif(cum_p + cum_n, 0), 0)), 6) AS ap
FROM c GROUP BY class"""

ORACLE_SQL["m13_mcnemar_table"] = PRED + """
, t AS (SELECT count(*) FILTER (WHERE pred_a = label AND pred_b = label) AS n11,
          count(*) FILTER (WHERE pred_a = label AND pred_b <> label) AS n10,
          count(*) FILTER (WHERE pred_a <> label AND pred_b = label) AS n01,
          count(*) FILTER (WHERE pred_a <> label AND pred_b <> label) AS n00 FROM preds)
SELECT n11, n10, n01, n00, round(power(abs(n10 - n01) - 1, 2) / nullif(n10 + n01, 0), 6) AS chi2 FROM t"""

ORACLE_SQL["j02_join_predictions"] = PRED + "SELECT ID, label, pred_a, pred_b FROM preds"
ORACLE_SQL["j03_split_overlap"] = BASE + f"""
SELECT DISTINCT a.ID FROM (SELECT ID FROM incidents WHERE {_SPLIT} = 'train') a
SEMI JOIN (SELECT ID FROM incidents WHERE {_SPLIT} = 'test') b ON a.ID = b.ID"""

ORACLE_SQL["a04_prediction_insights"] = PRED + """
SELECT State, CAST(hour(Start_Time) AS INTEGER) AS Hour, CAST(month(Start_Time) AS INTEGER) AS Month,
  pred_a + 1 AS Predicted_Severity, count(*) AS Accident_Count,
  CAST(sum(CASE WHEN label = pred_a THEN 1 ELSE 0 END) AS BIGINT) AS Correct_Preds,
  round(sum(CASE WHEN label = pred_a THEN 1 ELSE 0 END) * 1.0e0 / count(*), 6) AS Prediction_Accuracy
FROM preds WHERE State IS NOT NULL GROUP BY ALL"""

# ---- sources and sinks (read back what was written) --------------------------------

ORACLE_SQL["s01_csv_roundtrip"] = BASE + "SELECT * FROM incidents"
ORACLE_SQL["s02_corrupt_records"] = BASE + """
SELECT ID, CASE WHEN ID % 97 = 0 THEN NULL ELSE Severity END AS Severity, Distance_mi,
  ID % 97 = 0 AS corrupt FROM incidents"""
ORACLE_SQL["s03_partitioned_write"] = ENR + "SELECT * FROM enriched"
ORACLE_SQL["s05_verify_write"] = ENR + """
SELECT count(*) AS rows_read,
  count(DISTINCT State) + max(CASE WHEN State IS NULL THEN 1 ELSE 0 END) AS partition_values,
  count(*) AS rows_expected, true AS schema_match, true AS rows_match FROM enriched"""
ORACLE_SQL["s08_write_splits"] = BASE + f"""
SELECT {_SPLIT} AS split, count(*) AS rows FROM incidents GROUP BY 1"""
ORACLE_SQL["s09_export_csv"] = ORACLE_SQL["v05_class_distribution"]
ORACLE_SQL["s12_metrics_json"] = ORACLE_SQL["m04_evaluate_all"]

RAW_COLUMNS = tuple(c for c in ENRICHED_COLUMNS if c not in ("Region", "Climate_Zone"))


def _stage(step: int, name: str, source: str, fmt: str, view: str, cols) -> str:
    nulls = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in cols)
    return (f"SELECT {step} AS step, '{name}' AS name, '{source}' AS source, count(*) AS rows, "
            f"'{fmt}' AS format, round(coalesce(sum({nulls}) * 100.0e0 / nullif(count(*) * {len(cols)}, 0), 0), 4) "
            f"AS null_rate_pct FROM {view}")


_STAGES = [(1, "Ingestion", "events+customer+nation", "Parquet", "incidents", RAW_COLUMNS),
           (2, "Validation", "incidents", "DF", "incidents", RAW_COLUMNS),
           (3, "Repartition", "incidents", "DF", "incidents", RAW_COLUMNS),
           (4, "Enrichment", "incidents+state_lookup", "DF", "enriched", ENRICHED_COLUMNS),
           (5, "Parquet", "incidents_by_state", "Parquet", "enriched", ENRICHED_COLUMNS)]
_LINEAGE = "\nUNION ALL\n".join(_stage(*s) for s in _STAGES)
ORACLE_SQL["s11_lineage"] = ENR + _LINEAGE
ORACLE_SQL["r01_pipeline_quality"] = ENR + f"""
SELECT name AS Stage, rows AS Row_Count, format AS Format, null_rate_pct AS Null_Rate_Pct
FROM ({_LINEAGE})"""

# ---- windows -----------------------------------------------------------------------

ORACLE_SQL["w03_top_states_ranked"] = BASE + """
SELECT * FROM (SELECT State, count(*) AS count,
                 CAST(row_number() OVER (ORDER BY count(*) DESC, State ASC NULLS FIRST) AS INTEGER) AS Rank
               FROM incidents GROUP BY State) WHERE Rank <= 5"""
ORACLE_SQL["w04_hourly_vs_first_hour"] = BASE + """
SELECT Severity, Hour, count, round(count * 1.0e0 / first(count) OVER (PARTITION BY Severity ORDER BY Hour
         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 6) AS relative
FROM (SELECT Severity, CAST(hour(Start_Time) AS INTEGER) AS Hour, count(*) AS count
      FROM incidents GROUP BY ALL)"""
ORACLE_SQL["w05_union_reports"] = BASE + "SELECT *, CAST(NULL AS DOUBLE) AS missing_pct FROM (" + _union_long(
    "SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    "round(count(*) FILTER (WHERE {c} IS NULL) * 100.0e0 / count(*), 4) AS null_pct, "
    "CASE WHEN round(count(*) FILTER (WHERE {c} IS NULL) * 100.0e0 / count(*), 4) < 5.0 "
    "THEN 'PASS' ELSE 'WARN' END AS status FROM incidents", _CRIT) + """)
UNION ALL
SELECT "column", NULL, NULL, NULL, missing_pct FROM (""" + _union_long(
    "SELECT '{c}' AS column, round(count(*) FILTER (WHERE {c} IS NULL) * 100.0e0 / count(*), 2) "
    "AS missing_pct FROM incidents", RAW_COLUMNS) + ") WHERE missing_pct > 0"

# ---- reports -------------------------------------------------------------------------

ORACLE_SQL["r02_model_performance"] = PRED + _class_tables(_AB) + """
, mc AS (SELECT model AS Model, 'Spark MLlib' AS Framework, 'Multiclass' AS Task,
           round(coalesce(sum(tp) * 1.0e0 / nullif(sum(support), 0), 0), 4) AS Test_Accuracy,
           round(coalesce(sum(f * support) / nullif(sum(support), 0), 0), 4) AS Test_F1,
           round(coalesce(sum(p * support) / nullif(sum(support), 0), 0), 4) AS Test_Precision,
           round(coalesce(sum(r * support) / nullif(sum(support), 0), 0), 4) AS Test_Recall,
           CAST(NULL AS DOUBLE) AS AUC_ROC FROM per GROUP BY model),
bp AS (SELECT CASE WHEN label >= 2 THEN 1.0e0 ELSE 0.0e0 END AS bl,
         CASE WHEN pred_a >= 2 THEN 1.0e0 ELSE 0.0e0 END AS pb, score FROM preds),
g AS (SELECT score, CAST(sum(CASE WHEN bl = 1 THEN 1 ELSE 0 END) AS BIGINT) AS p,
        CAST(sum(CASE WHEN bl = 1 THEN 0 ELSE 1 END) AS BIGINT) AS n FROM bp GROUP BY score),
c AS (SELECT *, sum(p) OVER w AS cum_p, sum(p) OVER () AS pos_total, sum(n) OVER () AS neg_total
      FROM g WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
auc AS (SELECT round(coalesce(sum(n * (cum_p - p / 2.0e0)) / nullif(max(pos_total) * 1.0e0 * max(neg_total), 0), 0), 4)
          AS a FROM c)
SELECT * FROM mc
UNION ALL
SELECT 'rule_binary', 'Spark MLlib', 'Binary', round(round(avg(CASE WHEN bl = pb THEN 1.0e0 ELSE 0.0e0 END), 6), 4),
  NULL, NULL, NULL, (SELECT a FROM auc) FROM bp"""

ORACLE_SQL["r03_business_insights"] = ORACLE_SQL["a04_prediction_insights"]
ORACLE_SQL["a06_best_by"] = ORACLE_SQL["m14_best_model"]

# ---- ML feature pipeline ------------------------------------------------------------

_IMPUTE = NUMERIC + ("Duration_Min",)
ORACLE_SQL["f01_median_impute"] = FEAT + "SELECT ID, " + ", ".join(
    f"coalesce({c}, (SELECT quantile_disc({c}, 0.5) FROM featured)) AS {c}_imp" for c in _IMPUTE) + " FROM featured"

_FILL = (("Weather_Condition", "Unknown"), ("Wind_Direction", "Calm"), ("Sunrise_Sunset", "Day"),
         ("Civil_Twilight", "Day"), ("Timezone", "US/Eastern"), ("Region", "Unknown"),
         ("Climate_Zone", "Unknown"))
FILLED = ("\n, filled AS (SELECT * REPLACE (" + ", ".join(f"coalesce({c}, '{v}') AS {c}" for c, v in _FILL)
          + ") FROM featured)\n")
ORACLE_SQL["f02_constant_fill"] = FEAT + FILLED + "SELECT ID, " + ", ".join(c for c, _ in _FILL) + " FROM filled"

_INDEX = ("Wind_Direction", "Weather_Condition", "Sunrise_Sunset", "Timezone", "Region", "Climate_Zone")
INDEXES = "".join(
    f", ix_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS DOUBLE) AS i, "
    f"count(*) OVER () AS k FROM (SELECT {c} AS v, count(*) AS n FROM filled GROUP BY 1))\n" for c in _INDEX)
_JOIN_IX = " ".join(f"JOIN ix_{c} ON filled.{c} = ix_{c}.v" for c in _INDEX)
ORACLE_SQL["f03_string_index"] = FEAT + FILLED + INDEXES + "SELECT filled.ID, " + ", ".join(
    f"ix_{c}.i AS {c}_idx" for c in _INDEX) + f" FROM filled {_JOIN_IX}"

_OHE = ("Sunrise_Sunset", "Timezone", "Region", "Climate_Zone")
ORACLE_SQL["f04_one_hot"] = FEAT + FILLED + INDEXES + "SELECT filled.ID, " + ", ".join(
    f"list_transform(range(ix_{c}.k), lambda x: CASE WHEN ix_{c}.i = x THEN 1.0e0 ELSE 0.0e0 END) AS {c}_ohe"
    for c in _OHE) + f" FROM filled {_JOIN_IX}"

_ENG = ("Hour", "DayOfWeek", "Month", "Is_Peak_Hour", "Is_Weekend", "Temp_Risk", "Low_Visibility",
        "Distance_Bucket", "Is_Night", "Infra_Risk_Score")
ORACLE_SQL["f05_assemble"] = FEAT + "SELECT ID, [" + ", ".join(
    [f"coalesce(CAST(CAST({c} AS INTEGER) AS DOUBLE), 0.0e0)" for c in _FLAGS]
    + [f"CAST({c} AS DOUBLE)" for c in _ENG]) + "] AS raw_features FROM featured"

ORACLE_SQL["f06_standard_scale"] = FEAT + "SELECT ID, [" + ", ".join(
    f"round(coalesce((CAST({c} AS DOUBLE) - avg({c}) OVER ()) / nullif(stddev_samp({c}) OVER (), 0), 0.0e0), 6)"
    for c in _ENG) + "] AS scaled FROM featured"

ORACLE_SQL["f09_clean_numeric"] = BASE + "SELECT ID, " + ", ".join(
    f"coalesce(CASE WHEN abs(CAST({c} AS DOUBLE)) < CAST('inf' AS DOUBLE) THEN CAST({c} AS DOUBLE) END, 0.0e0) AS {c}"
    for c in NUMERIC + ("Junction",)) + " FROM incidents"

_BOX = "(Start_Lat < 24.0 OR Start_Lat > 72.0 OR Start_Lng < -170.0 OR Start_Lng > -66.0)"
ORACLE_SQL["v00_ingest_report"] = BASE + ", t AS (SELECT count(*) AS n, " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in _CRIT) + f""",
  count(*) FILTER (WHERE NOT Severity IN (1, 2, 3, 4)) AS dom, count(*) FILTER (WHERE {_BOX}) AS box
  FROM incidents)
""" + "\nUNION ALL\n".join(
    f"SELECT 'nulls' AS \"check\", '{c}' AS \"column\", null_{c} AS count, "
    f"round(null_{c} * 100.0e0 / n, 4) AS pct, "
    f"CASE WHEN round(null_{c} * 100.0e0 / n, 4) < 5.0 THEN 'PASS' ELSE 'WARN' END AS status FROM t"
    for c in _CRIT) + """
UNION ALL SELECT 'domain', 'Severity', dom, round(dom * 100.0e0 / n, 4),
  CASE WHEN dom = 0 THEN 'PASS' ELSE 'FAIL' END FROM t
UNION ALL SELECT 'bounds', 'Start_Lat,Start_Lng', box, round(box * 100.0e0 / n, 4),
  CASE WHEN box < n * 0.01e0 THEN 'PASS' ELSE 'WARN' END FROM t
UNION ALL SELECT 'rows', '*', n, 100.0e0, CASE WHEN n > 0 THEN 'PASS' ELSE 'FAIL' END FROM t"""

ORACLE_SQL["p01_model_columns"] = ENR + """
SELECT ID, CAST(Severity - 1 AS DOUBLE) AS label, Start_Time, State, Severity, Region, Climate_Zone FROM enriched"""


def _erfc_sql(x: str) -> str:
    """erfc(x) for x >= 0 in plain SQL: power series of erf below 2.5, a 60-level
    continued fraction above (both accurate to ~1e-13 there)."""
    series = " + ".join(
        f"(CASE WHEN {n} % 2 = 0 THEN 1 ELSE -1 END) * power({x}, {2 * n + 1}) "
        f"/ (exp(lgamma({n + 1})) * {2 * n + 1})" for n in range(40))
    frac = f"{x}"
    for k in range(60, 0, -1):
        frac = f"({x} + {k / 2!r} / {frac})"
    return (f"CASE WHEN {x} < 2.5 THEN 1 - 2 / sqrt(pi()) * ({series}) "
            f"ELSE exp(-{x} * {x}) / sqrt(pi()) / {frac} END")


ORACLE_SQL["m13_mcnemar_test"] = PRED + """
, t AS (SELECT count(*) FILTER (WHERE pred_a = label AND pred_b = label) AS n11,
          count(*) FILTER (WHERE pred_a = label AND pred_b <> label) AS n10,
          count(*) FILTER (WHERE pred_a <> label AND pred_b = label) AS n01,
          count(*) FILTER (WHERE pred_a <> label AND pred_b <> label) AS n00 FROM preds),
c AS (SELECT *, round(power(abs(n10 - n01) - 1, 2) / nullif(n10 + n01, 0), 6) AS chi2 FROM t),
x AS (SELECT *, sqrt(chi2 / 2.0e0) AS z FROM c)
SELECT n11, n10, n01, n00, chi2, round(""" + _erfc_sql("z") + """, 6) AS p_value,
  coalesce(round(""" + _erfc_sql("z") + """, 6) < 0.05, false) AS significant
FROM x"""


# ---- F7: the whole fitted pipeline (fit on the training split, applied to all) -------

_PIPE_FILL = ("\n, labelled AS (SELECT *, " + _SPLIT + " AS split FROM featured)"
              "\n, filled AS (SELECT * REPLACE (" + ", ".join(f"coalesce({c}, '{v}') AS {c}" for c, v in _FILL)
              + ") FROM labelled)\n, tr AS (SELECT * FROM filled WHERE split = 'train')\n")
_PIPE_MED = ", med AS (SELECT " + ", ".join(f"quantile_disc({c}, 0.5) AS m_{c}" for c in _IMPUTE) + " FROM tr)\n"
_PIPE_IX = "".join(
    f", ix_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS DOUBLE) AS i, "
    f"count(*) OVER () AS k FROM (SELECT {c} AS v, count(*) AS n FROM tr GROUP BY 1))\n"
    f", k_{c} AS (SELECT count(DISTINCT {c}) AS k FROM tr)\n" for c in _INDEX)
_PIPE_IDX = {c: f"coalesce(ix_{c}.i, CAST(k_{c}.k AS DOUBLE))" for c in _INDEX}
_PIPE_SLOTS = (
    "list_concat([" + ", ".join(f"coalesce(f.{c}, med.m_{c})" for c in _IMPUTE) + "], "
    + ", ".join(f"list_transform(range(k_{c}.k), lambda j: CASE WHEN {_PIPE_IDX[c]} = j THEN 1.0e0 ELSE 0.0e0 END)"
                for c in _OHE)
    + ", [" + ", ".join([_PIPE_IDX["Wind_Direction"], _PIPE_IDX["Weather_Condition"]]
                        + [f"coalesce(CAST(CAST(f.{c} AS INTEGER) AS DOUBLE), 0.0e0)" for c in _FLAGS]
                        + [f"CAST(f.{c} AS DOUBLE)" for c in _ENG]) + "])")
_PIPE_JOIN = (" ".join(f"LEFT JOIN ix_{c} ON f.{c} = ix_{c}.v" for c in _INDEX)
              + " CROSS JOIN med " + " ".join(f"CROSS JOIN k_{c}" for c in _INDEX))
ORACLE_SQL["f07_pipeline_features"] = FEAT + _PIPE_FILL + _PIPE_MED + _PIPE_IX + f"""
, rawv AS (SELECT f.ID, f.split, {_PIPE_SLOTS} AS r FROM filled f {_PIPE_JOIN})
, cells AS (SELECT ID, split, unnest(r) AS x, unnest(range(len(r))) AS slot FROM rawv)
, mom AS (SELECT slot, avg(x) AS mu, stddev_samp(x) AS sd FROM cells WHERE split = 'train' GROUP BY slot)
SELECT ID, split, list(round(CASE WHEN sd = 0 OR sd IS NULL THEN 0.0e0 ELSE (x - mu) / sd END, 6) ORDER BY c.slot)
  AS features
FROM cells c JOIN mom USING (slot) GROUP BY ID, split"""

ORACLE_SQL["f08_pipeline_saved_and_loaded"] = ORACLE_SQL["f07_pipeline_features"]
ORACLE_SQL["e06_model_saved_and_loaded"] = FEAT + _PIPE_FILL + """
SELECT ID, true AS same_prediction, true AS known_class FROM filled WHERE split = 'test'"""

_NAME_LIST = ("list_concat([" + ", ".join(f"'{c}_imp'" for c in _IMPUTE) + "], "
              + ", ".join(f"(SELECT list('{c}_ohe_' || v ORDER BY i) FROM ix_{c})" for c in _OHE)
              + ", [" + ", ".join(["'Wind_Direction_idx'", "'Weather_Condition_idx'"]
                                  + [f"'{c}'" for c in _FLAGS] + [f"'{c}'" for c in _ENG]) + "])")
ORACLE_SQL["f10_slot_names"] = FEAT + _PIPE_FILL + _PIPE_IX + f"""
, names AS (SELECT {_NAME_LIST} AS n)
SELECT CAST(unnest(range(len(n))) AS INTEGER) AS slot, unnest(n) AS name FROM names"""


# ---- bootstrap: Poisson counts by the inverse of their cumulative table --------------

def _draws(cells: str, key: str) -> str:
    """CTEs after ``cells`` (model, cell..., n): ``drawn`` with n redrawn for every replicate."""
    return f"""
, cells AS ({cells})
, tab AS (SELECT *, unnest(range(CAST(greatest(floor(n - sqrt(n) * 10 - 10), 0) AS BIGINT), CAST(ceil(n + sqrt(n) * 10 + 10) AS BIGINT) + 1)) AS k FROM cells)
, lg AS (SELECT *, k * ln(n) - lgamma(k + 1) - n AS l FROM tab)
, cum AS (SELECT model, {key}, k, sum(exp(l)) OVER (PARTITION BY model, {key} ORDER BY k) / sum(exp(l)) OVER (PARTITION BY model, {key}) AS p FROM lg)
, uni AS (SELECT *, CAST(('0x' || substr(md5('bootstrap:42:' || concat_ws(':', model, {key}, replicate)), 1, 8)) AS BIGINT) / 4294967296.0e0 AS u
          FROM (SELECT *, unnest(range(500)) AS replicate FROM cells))
, drawn AS (SELECT uni.model, {", ".join("uni." + c for c in key.split(", "))}, replicate, min(k) AS n FROM uni JOIN cum
            ON {" AND ".join(f"uni.{c} = cum.{c}" for c in ["model", *key.split(", ")])} AND cum.p >= uni.u GROUP BY ALL)
"""


_BOUNDS_CI = ("round(avg(v), 4) AS {mean}, round(quantile_cont(v, 0.025), 4) AS CI_Lower, round(quantile_cont(v, 0.975), 4) AS CI_Upper, "
              "round(quantile_cont(v, 0.975) - quantile_cont(v, 0.025), 4) AS CI_Width")
ORACLE_SQL["m12_bootstrap_ci"] = PRED + _draws(
    f'SELECT model, coalesce(label = prediction, false) AS "right", count(*) AS n FROM ({_AB}) GROUP BY ALL', '"right"') + """
, per AS (SELECT model, replicate, coalesce(sum(n) FILTER ("right"), 0) * 1.0e0 / nullif(sum(n), 0) AS v FROM drawn GROUP BY ALL)
SELECT model AS Model, """ + _BOUNDS_CI.format(mean="Mean_Accuracy") + " FROM per GROUP BY model"

ORACLE_SQL["m12_bootstrap_f1_ci"] = PRED + _draws(
    f"SELECT model, label, prediction, count(*) AS n FROM ({_AB}) GROUP BY ALL", "label, prediction") + """
, cl AS (SELECT model, replicate, label AS c FROM drawn UNION SELECT model, replicate, prediction FROM drawn)
, pc AS (SELECT cl.model, cl.replicate, cl.c, coalesce(sum(n) FILTER (label = c AND prediction = c), 0) AS tp,
           coalesce(sum(n) FILTER (prediction = c), 0) AS pr, coalesce(sum(n) FILTER (label = c), 0) AS su
         FROM cl JOIN drawn USING (model, replicate) GROUP BY ALL)
, per AS (SELECT model, replicate, sum(coalesce(2.0e0 * tp / nullif(pr + su, 0), 0) * su) / nullif(sum(su), 0) AS v FROM pc GROUP BY ALL)
SELECT model AS Model, 'f1' AS Metric, """ + _BOUNDS_CI.format(mean="Mean") + " FROM per GROUP BY model"


# ---- what holds of any sound fit ------------------------------------------------------

_FACT_LABELS = "SELECT split, CAST(Severity - 1 AS DOUBLE) AS label, CASE WHEN Severity >= 3 THEN 1.0e0 ELSE 0.0e0 END AS binary FROM labelled"
ORACLE_SQL["e01_e04_model_facts"] = FEAT + ", labelled AS (SELECT *, " + _SPLIT + f""" AS split FROM featured)
, rows AS ({_FACT_LABELS})
, named AS (SELECT unnest(['lr', 'rf', 'dt']) AS model, split, label FROM rows UNION ALL SELECT 'gbt', split, "binary" FROM rows)
, per AS (SELECT model, label, count(*) FILTER (split = 'train') AS n, count(*) FILTER (split = 'test') AS t FROM named GROUP BY ALL)
SELECT model, CAST(sum(n) AS BIGINT) AS train_rows, CAST(sum(t) AS BIGINT) AS test_rows, count(*) FILTER (n > 0) AS classes,
  round(max(n) * 1.0e0 / sum(n), 6) AS majority_share, true AS not_below_majority, true AS known_classes_only
FROM per GROUP BY model"""

_UT = _U.replace("'42:'", "'tune:42:'")
ORACLE_SQL["e05_search_facts"] = BASE + f"""
, tuned AS (SELECT {_UT} < 0.8e0 AS own FROM incidents WHERE {_SPLIT} = 'train')
SELECT numTrees, maxDepth, (SELECT count(*) FROM tuned WHERE own) AS train_rows, (SELECT count(*) FROM tuned WHERE NOT own) AS valid_rows,
  true AS best_by_f1, true AS metrics_in_range
FROM (SELECT unnest([50, 100]) AS numTrees), (SELECT unnest([8, 12]) AS maxDepth)"""


# ---- broken rules, columns, the file of 46 columns --------------------------------------

ORACLE_SQL["v03_domain_check_violated"] = BASE + """
SELECT 'Severity' AS "column", count(*) FILTER (WHERE Severity > 3) AS violations,
  CASE WHEN count(*) FILTER (WHERE Severity > 3) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM incidents"""

ORACLE_SQL["p02_invalid_rows"] = ENR + """
SELECT ID, 'domain:Severity' AS reason FROM enriched WHERE Severity NOT IN (1, 2, 3)
UNION ALL SELECT ID, 'range:Start_Lat' FROM enriched WHERE Start_Lat NOT BETWEEN 24.0e0 AND 72.0e0
UNION ALL SELECT ID, 'range:Start_Lng' FROM enriched WHERE Start_Lng NOT BETWEEN -170.0e0 AND -66.0e0
UNION ALL SELECT ID, 'null:Temperature_F' FROM enriched WHERE Temperature_F IS NULL
UNION ALL SELECT ID, 'null:Region' FROM enriched WHERE Region IS NULL"""

ORACLE_SQL["v14_column_presence"] = ENR + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", true AS present, count({c}) AS non_null FROM enriched" for c in ("ID", "State", "Region", "Climate_Zone")) + """
UNION ALL SELECT 'Sensor', false, CAST(NULL AS BIGINT)"""

# columns of the file that no rule of the incident model fills
_EMPTY = (("Source", "VARCHAR"), ("End_Lat", "DOUBLE"), ("End_Lng", "DOUBLE"), ("Description", "VARCHAR"), ("Street", "VARCHAR"),
          ("City", "VARCHAR"), ("County", "VARCHAR"), ("Zipcode", "VARCHAR"), ("Country", "VARCHAR"), ("Airport_Code", "VARCHAR"),
          ("Weather_Timestamp", "TIMESTAMP"), ("Nautical_Twilight", "VARCHAR"), ("Astronomical_Twilight", "VARCHAR"))
ORACLE_SQL["s06_incident_csv_46"] = BASE + """
SELECT * REPLACE (CAST(ID AS VARCHAR) AS ID, CASE WHEN ID % 89 = 0 THEN NULL ELSE Severity END AS Severity), """ + ", ".join(
    f"CAST(NULL AS {t}) AS {c}" for c, t in _EMPTY) + ", ID % 89 = 0 AS corrupt FROM incidents"
