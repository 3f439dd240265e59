"""The incident model over the input tables.

The reference works on one wide table of incident records.  Here that table is
derived from the ``events`` fact table (one incident per event) joined to its
customer's nation, which plays the part of the incident's state; ``nation`` x
``region`` is the state lookup.  Every column is a deterministic rule over the
inputs, so the same text in any SQL engine gives the same rows, and nulls,
boundary values and out-of-range coordinates are induced by rule rather than
sampled.

Work grows with ``events``: the fact table is scanned once with only the
columns used; the customer join is broadcast only behind a bounded row check
(otherwise sort-merge, with AQE skew splitting for a hot customer).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sevlens.operators.enrich import broadcast_if_bounded, enrich
from sevlens.sources.tables import table

# Fixed rule values (the oracle SQL repeats them).
SEVERITY_OF_EVENT = (("view", 1), ("click", 2), ("signup", 3), ("purchase", 3), ("error", 4))
# flag column -> modulus p: the flag is (user_id % p = 0)
FLAG_MODULI = (("Amenity", 13), ("Bump", 17), ("Crossing", 3), ("Give_Way", 19),
               ("Junction", 2), ("No_Exit", 23), ("Railway", 11), ("Roundabout", 29),
               ("Station", 31), ("Stop", 7), ("Traffic_Calming", 37),
               ("Traffic_Signal", 5), ("Turning_Loop", 41))
FLAG_COLUMNS = tuple(name for name, _ in FLAG_MODULI)
UNMATCHED_REGION = "MIDDLE EAST"   # left out of the lookup to exercise unmatched rows
WEATHER = ("Clear", "Cloudy", "Rain", "Snow")           # event_id % 5; 4 -> null
WIND = ("N", "E", "S", "W")                             # user_id % 5; 4 -> null
TIMEZONES = ("US/Eastern", "US/Central", "US/Mountain", "US/Pacific")  # user_id % 4

NUMERIC_COLUMNS = ("Temperature_F", "Wind_Chill_F", "Humidity_Pct", "Pressure_in",
                   "Visibility_mi", "Wind_Speed_mph", "Precipitation_in", "Distance_mi")
CATEGORICAL_COLUMNS = ("Weather_Condition", "Wind_Direction", "Sunrise_Sunset",
                       "Civil_Twilight", "Timezone")
CRITICAL_COLUMNS = ("ID", "Severity", "Start_Time", "State", "Temperature_F",
                    "Visibility_mi", "Weather_Condition")


def _case(col: Column, pairs) -> Column:
    expr = None
    for key, val in pairs:
        expr = F.when(col == key, F.lit(val)) if expr is None else expr.when(col == key, F.lit(val))
    return expr


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def incident_columns() -> dict[str, Column]:
    """Incident columns as expressions over (event_id, ts, user_id, event_type, value, props)."""
    eid, uid, val, ts = F.col("event_id"), F.col("user_id"), F.col("value"), F.col("ts")
    temperature = _null_when(eid % 10 == 0, val - F.lit(10.0))
    hour = F.hour(ts)
    cols: dict[str, Column] = {
        "ID": eid,
        "Severity": _case(F.col("event_type"), SEVERITY_OF_EVENT).cast("int"),
        "Start_Time": ts,
        "End_Time": ts + F.make_dt_interval(secs=(F.floor(val * 60) - 600)),
        "Start_Lat": F.lit(23.9) + (eid % 4850) / F.lit(100.0),
        "Start_Lng": F.lit(-170.5) + (uid % 105).cast("double"),
        "Temperature_F": temperature,
        "Wind_Chill_F": temperature - (uid % 7).cast("double"),
        "Humidity_Pct": _null_when(eid % 20 == 3, (uid % 100).cast("double")),
        "Pressure_in": F.lit(29.0) + (eid % 200) / F.lit(100.0),
        "Visibility_mi": F.get_json_object("props", "$.k").cast("double") / F.lit(10.0),
        "Wind_Speed_mph": _null_when(eid % 10 == 5, (eid % 50).cast("double")),
        "Precipitation_in": _null_when(eid % 3 == 0, (eid % 100) / F.lit(100.0)),
        "Distance_mi": val / F.lit(100.0),
        "Weather_Condition": _case(eid % 5, list(enumerate(WEATHER))),
        "Wind_Direction": _case(uid % 5, list(enumerate(WIND))),
        "Sunrise_Sunset": F.when(eid % 25 == 7, F.lit(None).cast("string"))
                           .when((hour >= 6) & (hour <= 17), F.lit("Day")).otherwise(F.lit("Night")),
        "Civil_Twilight": F.when((hour >= 5) & (hour <= 18), F.lit("Day")).otherwise(F.lit("Night")),
        "Timezone": _null_when(eid % 40 == 9, _case(uid % 4, list(enumerate(TIMEZONES)))),
    }
    for name, p in FLAG_MODULI:
        flag = (uid % p) == 0
        cols[name] = _null_when(eid % 50 == 1, flag) if name == "Junction" else flag
    return cols


def raw_incidents(spark: SparkSession, base_dir: str, events: DataFrame | None = None, state: bool = True) -> DataFrame:
    """The raw incident table (the reference's ingested CSV), state attached unless ``state`` is false.

    ``events`` may be a streaming frame: the dimension joins are stream-static.
    ``c_custkey`` and ``n_nationkey`` are the dimensions' primary keys, so the joins keep one row
    for each event without an aggregate; a caller that doesn't read State leaves them out.
    """
    events = table(spark, base_dir, "events") if events is None else events
    customer = table(spark, base_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    nation = table(spark, base_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("State"))
    cols = incident_columns()
    ordered = [cols["ID"].alias("ID")] + [c.alias(n) for n, c in cols.items() if n != "ID"]
    if not state:
        return events.select(*ordered)
    located = events
    for dimension, key in ((customer, "user_id"), (nation, "c_nationkey")):
        located = located.join(broadcast_if_bounded(dimension), key, "left")
    ordered.insert(4, F.col("State"))
    return located.select(*ordered)


def state_lookup(spark: SparkSession, base_dir: str) -> DataFrame:
    """(State, Region, Climate_Zone) dimension from nation x region."""
    nation = table(spark, base_dir, "nation")
    region = table(spark, base_dir, "region")
    return (nation.join(broadcast_if_bounded(region), nation.n_regionkey == region.r_regionkey)
            .where(F.col("r_name") != UNMATCHED_REGION)
            .select(F.col("n_name").alias("State"), F.col("r_name").alias("Region"),
                    F.concat(F.lit("Zone_"), (F.col("n_nationkey") % 4).cast("string"))
                    .alias("Climate_Zone")))


def enriched_incidents(spark: SparkSession, base_dir: str) -> DataFrame:
    """Raw incidents left-joined to the state lookup on State."""
    return enrich(raw_incidents(spark, base_dir), state_lookup(spark, base_dir), "State", "left")


# Rule-based predictor used to value-check the evaluation operators.
CLASS_CENTERS = (5.0, 25.0, 60.0, 200.0)      # per-class score: 1 / (1 + |100 * Distance_mi - center|)
PRED_A_EDGES = (0.15, 0.35, 0.90)


def rule_predictions(incidents: DataFrame) -> DataFrame:
    """(ID, Start_Time, State, label, pred_a, pred_b, score, score_0..score_3)."""
    d = F.col("Distance_mi")
    pred_a = (F.when(d < PRED_A_EDGES[0], 0.0).when(d < PRED_A_EDGES[1], 1.0)
              .when(d < PRED_A_EDGES[2], 2.0).otherwise(3.0))
    cols = {
        "label": (F.col("Severity") - 1).cast("double"),   # as transform.label_from_severity
        "pred_a": pred_a,
        "pred_b": F.when(F.col("ID") % 3 == 0, 1.0).otherwise(2.0),
        "score": d,
    }
    for k, center in enumerate(CLASS_CENTERS):
        cols[f"score_{k}"] = F.lit(1.0) / (F.lit(1.0) + F.abs(d * F.lit(100.0) - F.lit(center)))
    kept = [c for c in ("ID", "Start_Time", "State") if c in incidents.columns]
    return incidents.select(*kept, *[c.alias(n) for n, c in cols.items()])
