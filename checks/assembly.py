"""Whole recipes: assembly, storage and the catalogue."""

from __future__ import annotations

import datetime as dt

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import spineloom as sl
from checks.cleaning import rule
from checks.encoding import encoding, latest_sql, map_sql
from checks.fixtures import (
    EVENTS_RUN_DATE,
    ORDERS_RUN_DATE,
    Part,
    check,
    events,
    events_gaps,
    joined,
    orders_gaps,
    table,
    tidy,
    with_views,
)
from checks.windows import agg, slope_sql, time
from spineloom.durable import fresh_path

# A recipe of the usual size over the events: 11 aggregations, 3 encodings, 5 time features in two definitions.
ACTIVITY = {
    "entity_type": "user",
    "null_handlers": [rule("value", "median_impute", add_indicator=True), rule("event_type", "fill", "unknown")],
    "aggregations": [
        agg("events_7d", "event_id", "count", 7),
        agg("events_14d", "event_id", "count", 14),
        agg("value_mean_7d", "value", "mean", 7),
        agg("value_stddev_14d", "value", "stddev", 14),
        agg("events_alltime", "event_id", "count"),
    ],
    "encodings": [
        encoding("type_share", "event_type", "frequency"),
        encoding("props_label", "props", "label"),
    ],
    "time_windows": [
        time("days_since_last", "event_date", "days_diff"),
        time("id_mean_7d", "event_id", "rolling_mean", 7),
        time("value_slope_30d", "value", "rolling_slope", 30),
    ],
}
SPEND = {
    "entity_type": "user",
    "null_handlers": [rule("value", "drop"), rule("event_type", "fill", "none", add_indicator=True)],
    "aggregations": [
        agg("spend_7d", "value", "sum", 7),
        agg("spend_14d", "value", "sum", 14),
        agg("spend_mean_7d", "value", "mean", 7),
        agg("spends_1d", "event_id", "count", 1),
        agg("spend_max_14d", "value", "max", 14),
        agg("types_missing", "event_type_was_null", "sum"),
    ],
    "encodings": [encoding("spend_type_share", "event_type", "frequency")],
    "time_windows": [
        time("spend_slope_7d", "value", "rolling_slope", 7),
        time("spend_rolling_7d", "value", "rolling_mean"),
    ],
}


def assemble(spark, sf_dir: str, definitions: list[dict], exact_median: bool = True) -> DataFrame:
    df = events_gaps(spark, sf_dir)
    return sl.assemble_features(df, definitions, "user_id", "event_date", EVENTS_RUN_DATE, exact_median=exact_median)


def _since(days: int) -> str:
    return f"event_date >= DATE '2024-01-31' - {days}"


ACTIVITY_VIEW = """SELECT event_id, user_id, props, event_date, COALESCE(event_type, 'unknown') AS event_type,
    COALESCE(value, (SELECT quantile_disc(value, 0.5) FROM evt_gaps)) AS value FROM evt_gaps"""
SPEND_VIEW = """SELECT event_id, user_id, event_date, COALESCE(event_type, 'none') AS event_type, value,
    CAST(event_type IS NULL AS INTEGER) AS event_type_was_null FROM evt_gaps WHERE value IS NOT NULL"""

ACTIVITY_PARTS = [
    Part("events_7d", "COUNT(event_id)", "activity", _since(7), double=False),
    Part("events_14d", "COUNT(event_id)", "activity", _since(14), double=False),
    Part("value_mean_7d", "AVG(value)", "activity", _since(7)),
    Part("value_stddev_14d", "STDDEV_SAMP(value)", "activity", _since(14)),
    Part("events_alltime", "COUNT(event_id)", "activity", double=False),
    Part("type_share", "MAX(share)", "activity_type"),
    Part("props_label", "MAX(label)", "activity_props"),
    Part(
        "days_since_last",
        "CAST(date_diff('day', MAX(event_date), DATE '2024-01-31') AS INTEGER)",
        "activity",
        double=False,
    ),
    Part("id_mean_7d", "AVG(event_id)", "activity", _since(7)),
    Part("value_slope_30d", slope_sql("event_date", "value", "2024-01-31", 30), "activity", _since(30)),
]
SPEND_PARTS = [
    Part("spend_7d", "SUM(value)", "spend", _since(7)),
    Part("spend_14d", "SUM(value)", "spend", _since(14)),
    Part("spend_mean_7d", "AVG(value)", "spend", _since(7)),
    Part("spends_1d", "COUNT(event_id)", "spend", _since(1), double=False),
    Part("spend_max_14d", "MAX(value)", "spend", _since(14)),
    Part("types_missing", "CAST(SUM(event_type_was_null) AS BIGINT)", "spend", double=False),
    Part("spend_type_share", "MAX(share)", "spend_type"),
    Part("spend_slope_7d", slope_sql("event_date", "value", "2024-01-31", 7), "spend", _since(7)),
    Part("spend_rolling_7d", "AVG(value)", "spend", _since(7)),
]


def _coded(view: str, column: str) -> str:
    """Map columns of each user's latest category, one row per user."""
    return (
        f"SELECT l.user_id, m.share, m.label FROM ({latest_sql(view, 'user_id', 'event_date', column)}) l"
        f" JOIN ({map_sql(view, column)}) m ON l.category = m.category"
    )


def assembled_sql(parts: list[Part], extra: str = "") -> str:
    return with_views(
        joined("evt_gaps", "user_id", parts, extra=extra),
        "evt_gaps",
        activity=ACTIVITY_VIEW,
        spend=SPEND_VIEW,
        activity_type=_coded("activity", "event_type"),
        activity_props=_coded("activity", "props"),
        spend_type=_coded("spend", "event_type"),
    )


@check("assemble_features", assembled_sql(ACTIVITY_PARTS))
def assemble_features(spark, sf_dir):
    return tidy(assemble(spark, sf_dir, [ACTIVITY]))


@check("assemble_two_definitions", assembled_sql(ACTIVITY_PARTS + SPEND_PARTS))
def assemble_two_definitions(spark, sf_dir):
    return tidy(assemble(spark, sf_dir, [ACTIVITY, SPEND]))


@check("spec_compiled_features", assembled_sql(SPEND_PARTS))
def spec_compiled_features(spark, sf_dir):
    """The same recipe given as checked objects instead of dicts."""
    return tidy(assemble(spark, sf_dir, [sl.definition(SPEND)]))


@check(
    "assemble_dropped_entities",
    """WITH pending AS (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus <> 'P'
            AND o_orderpriority <> '4-NOT SPECIFIED')
    SELECT s.o_custkey, a.n, b.n_90d FROM (SELECT DISTINCT o_custkey FROM orders) s
    LEFT JOIN (SELECT o_custkey, COUNT(o_orderkey) AS n FROM pending GROUP BY o_custkey) a ON s.o_custkey = a.o_custkey
    LEFT JOIN (SELECT o_custkey, COUNT(o_orderkey) AS n_90d FROM pending WHERE d >= DATE '2001-08-02' - 90
        GROUP BY o_custkey) b ON s.o_custkey = b.o_custkey""",
)
def assemble_dropped_entities(spark, sf_dir):
    """Customers whose rows are all dropped stay, with NULL features."""
    spec = {
        "entity_type": "customer",
        "null_handlers": [rule("o_totalprice", "drop"), rule("o_orderpriority", "drop")],
        "aggregations": [agg("n", "o_orderkey", "count"), agg("n_90d", "o_orderkey", "count", 90)],
    }
    return sl.assemble_features(orders_gaps(spark, sf_dir), [spec], "o_custkey", "order_date", ORDERS_RUN_DATE)


@check(
    "assemble_timestamp_column",
    with_views(
        joined("evt_gaps", "user_id", ACTIVITY_PARTS + SPEND_PARTS),
        "evt_gaps",
        activity=ACTIVITY_VIEW,
        spend=SPEND_VIEW,
        activity_ts=ACTIVITY_VIEW.replace("event_date,", "ts AS event_date,"),
        spend_ts=SPEND_VIEW.replace("event_date,", "ts AS event_date,"),
        activity_type=_coded("activity_ts", "event_type"),
        activity_props=_coded("activity_ts", "props"),
        spend_type=_coded("spend_ts", "event_type"),
    ),
)
def assemble_timestamp_column(spark, sf_dir):
    """The date column is the event's timestamp: still one scan, and the latest category is that of the last instant."""
    df = events_gaps(spark, sf_dir)
    definitions = [ACTIVITY, SPEND]
    return tidy(sl.assemble_features(df, definitions, "user_id", "ts", EVENTS_RUN_DATE, exact_median=True))


@check(
    "store_roundtrip",
    f"SELECT 'user' AS entity_type, '2024-01-31' AS \"date\", user_id AS entity, spend_7d AS value FROM ({assembled_sql(SPEND_PARTS)})"
    " UNION ALL SELECT 'customer', '2001-08-02', o_custkey, CAST(COUNT(*) AS DOUBLE) FROM orders GROUP BY o_custkey",
)
def store_roundtrip(spark, sf_dir):
    """Two entity types with columns of their own; one partition is written twice; each type is read back."""
    root = fresh_path(spark, "store")
    features = assemble(spark, sf_dir, [SPEND])
    spec = agg("n_orders", "o_orderkey", "count")
    customers = sl.aggregate_features(orders_gaps(spark, sf_dir), [spec], "o_custkey", "order_date", ORDERS_RUN_DATE)
    sl.write_features(customers, root, "customer", ORDERS_RUN_DATE)
    sl.write_features(features.withColumn("spend_7d", F.lit(-1.0)), root, "user", EVENTS_RUN_DATE)
    sl.write_features(features, root, "user", EVENTS_RUN_DATE)
    users = sl.read_features(spark, root, "user")
    users = tidy(users.select("entity_type", "date", F.col("user_id").cast("bigint").alias("entity"), F.col("spend_7d").alias("value")))
    counts = sl.read_features(spark, root, "customer", ORDERS_RUN_DATE).select(
        "entity_type", "date", F.col("o_custkey").cast("bigint").alias("entity"), F.col("n_orders").cast("double").alias("value")
    )
    return users.union(counts).withColumn("date", F.col("date").cast("string"))


@check(
    "store_added_feature",
    """SELECT user_id, '2024-01-30' AS "date", CAST(NULL AS BIGINT) AS n FROM (SELECT DISTINCT user_id FROM events)
    UNION ALL SELECT user_id, '2024-01-31', COUNT(*) FROM events GROUP BY user_id""",
)
def store_added_feature(spark, sf_dir):
    """The second day's recipe has one feature more; both days are read together."""
    root = fresh_path(spark, "store")
    df = events_gaps(spark, sf_dir)
    counted = sl.aggregate_features(df, [agg("n", "event_id", "count")], "user_id", "event_date", EVENTS_RUN_DATE)
    sl.write_features(sl.entity_spine(df, "user_id"), root, "user", "2024-01-30")
    sl.write_features(counted, root, "user", EVENTS_RUN_DATE)
    stored = sl.read_features(spark, root, "user")
    return stored.select("user_id", F.col("date").cast("string").alias("date"), "n")


@check("store_empty_rerun", "SELECT DISTINCT user_id, '2024-01-30' AS \"date\" FROM events")
def store_empty_rerun(spark, sf_dir):
    """A rerun without rows clears its own day and no other."""
    root = fresh_path(spark, "store")
    users = sl.entity_spine(events_gaps(spark, sf_dir), "user_id")
    sl.write_features(users, root, "user", "2024-01-30")
    sl.write_features(users, root, "user", EVENTS_RUN_DATE)
    sl.write_features(users.where("user_id IS NULL"), root, "user", EVENTS_RUN_DATE)
    return sl.read_features(spark, root, "user").select("user_id", F.col("date").cast("string").alias("date"))


def _raw(spark, sf_dir: str) -> str:
    """One snapshot of the events, filed under the run date."""
    path = fresh_path(spark, "raw")
    snapshot = table(spark, sf_dir, "events").withColumn("event_date", F.col("ts").cast("date"))
    snapshot.withColumn("date", F.lit(dt.date(2024, 1, 31))).write.partitionBy("date").parquet(path)
    return path


def _run(spark, raw: str, name: str, specs: list[dict], registry: str) -> None:
    settings = sl.Settings(
        pipeline_name=name,
        entity_type="user",
        entity_key="user_id",
        date_column="event_date",
        run_date=EVENTS_RUN_DATE,
        raw_path=raw,
        store_path=fresh_path(spark, "store"),
        registry_path=registry,
        min_row_count=100,
    )
    sl.run_daily(spark, settings, specs)


def _declared(*specs: dict) -> list[tuple[str, str]]:
    kinds = (("aggregations", "aggregation"), ("encodings", "encoding"), ("time_windows", "time_window"))
    return [(f["name"], kind) for spec in specs for section, kind in kinds for f in spec[section]]


def _entries_sql(pipelines: dict[str, list[dict]]) -> str:
    rows = []
    for pipeline, specs in pipelines.items():
        declared = _declared(*specs)
        rows += [f"('{pipeline}', {len(declared)}, '{name}', '{kind}')" for name, kind in declared]
    return (
        "SELECT v.pipeline_name, 'user' AS entity_type, 'user_id' AS entity_key, '2024-01-31' AS run_date,"
        " CAST(v.feature_count AS INTEGER) AS feature_count, v.name, v.type, u.users FROM (VALUES "
        + ", ".join(rows)
        + ") AS v(pipeline_name, feature_count, name, type), (SELECT COUNT(DISTINCT user_id) AS users FROM events) u"
    )


def _entries(spark, registry: DataFrame) -> DataFrame:
    """One row per declared feature, with the number of rows found at the path the entry names."""
    stored = {r["pipeline_name"]: r["output_path"] for r in registry.select("pipeline_name", "output_path").collect()}
    counts = None
    for pipeline, path in stored.items():
        users = spark.read.parquet(path).agg(F.countDistinct("user_id").alias("users"))
        users = users.select(F.lit(pipeline).alias("pipeline_name"), "users")
        counts = users if counts is None else counts.unionByName(users)
    features = registry.select(
        "pipeline_name", "entity_type", "entity_key", "run_date", "feature_count", F.inline("features")
    )
    return features.join(counts, "pipeline_name", "left")


@check("registry_entry", _entries_sql({"activity": [ACTIVITY, SPEND]}))
def registry_entry(spark, sf_dir):
    """A full run over the events leaves one catalogue entry that points at the stored features."""
    path = fresh_path(spark, "registry")
    _run(spark, _raw(spark, sf_dir), "activity", [ACTIVITY, SPEND], path)
    return _entries(spark, sl.read_registry(spark, path))


@check("registry_upsert", _entries_sql({"activity": [ACTIVITY], "spend": [SPEND]}))
def registry_upsert(spark, sf_dir):
    """A second run of a pipeline replaces its entry; the entry of the other pipeline stays."""
    path, raw = fresh_path(spark, "registry"), _raw(spark, sf_dir)
    _run(spark, raw, "spend", [SPEND], path)
    _run(spark, raw, "activity", [ACTIVITY, SPEND], path)
    _run(spark, raw, "activity", [ACTIVITY], path)
    return _entries(spark, sl.read_registry(spark, path))


@check(
    "registry_merge",
    _entries_sql({"activity": [ACTIVITY], "spend": [SPEND]}),
)
def registry_merge(spark, sf_dir):
    """Two catalogues united: of a pipeline that both know, the newer entry."""
    raw = _raw(spark, sf_dir)
    old, new = fresh_path(spark, "registry"), fresh_path(spark, "registry")
    _run(spark, raw, "activity", [ACTIVITY, SPEND], old)
    _run(spark, raw, "spend", [SPEND], old)
    _run(spark, raw, "activity", [ACTIVITY], new)
    return _entries(spark, sl.upsert(sl.read_registry(spark, old), sl.read_registry(spark, new)))


@check(
    "store_vector_all_types",
    """SELECT 'user' AS entity_type, user_id AS entity, CAST(COUNT(*) AS DOUBLE) AS n FROM events GROUP BY user_id
    UNION ALL SELECT 'customer', o_custkey, COUNT(*) FROM orders GROUP BY o_custkey""",
)
def store_vector_all_types(spark, sf_dir):
    """The whole store read at once, where one type keeps sparse vectors and another a name with a backtick."""
    root = fresh_path(spark, "store")
    kinds = [encoding("kind", "event_type", "onehot")]
    spec = {"entity_type": "user", "aggregations": [agg("n", "event_id", "count")], "encodings": kinds}
    users = sl.assemble_features(events_gaps(spark, sf_dir), [spec], "user_id", "event_date", EVENTS_RUN_DATE, onehot="vector")
    orders = sl.aggregate_features(orders_gaps(spark, sf_dir), [agg("n`o", "o_orderkey", "count")], "o_custkey", "order_date", ORDERS_RUN_DATE)
    sl.write_features(users, root, "user", EVENTS_RUN_DATE)
    sl.write_features(orders, root, "customer", ORDERS_RUN_DATE)
    found = sl.read_features(spark, root)
    # A one-hot vector has one 1 in it, so its sum tells whether it was read.
    ones = F.aggregate(vector_to_array("kind"), F.lit(0.0), lambda total, x: total + x)
    return found.select(
        "entity_type",
        F.coalesce("user_id", "o_custkey").alias("entity"),
        F.coalesce(F.col("n") * ones, F.col("`n``o`")).cast("double").alias("n"),
    )


@check(
    "store_side_by_side",
    """WITH evt AS (SELECT *, CAST(ts AS DATE) AS event_date FROM events),
    old AS (SELECT user_id, COUNT(*) AS n, SUM(value) AS total FROM evt WHERE event_date >= DATE '2024-01-30' - 7 GROUP BY user_id),
    now AS (SELECT user_id, COUNT(*) AS n, SUM(value) AS total FROM evt WHERE event_date >= DATE '2024-01-31' - 7 GROUP BY user_id)
    SELECT s.user_id, now.n AS n_20240131, ROUND(now.total, 8) AS total_20240131, old.n AS n_20240130,
        ROUND(old.total, 8) AS total_20240130
    FROM (SELECT DISTINCT user_id FROM evt) s LEFT JOIN now ON now.user_id = s.user_id LEFT JOIN old ON old.user_id = s.user_id""",
)
def store_side_by_side(spark, sf_dir):
    """Two days of the store, kept in buckets by user, joined without an exchange."""
    root = fresh_path(spark, "store")
    specs = [agg("n", "event_id", "count", 7), agg("total", "value", "sum", 7)]
    for day in ("2024-01-30", EVENTS_RUN_DATE):
        features = sl.aggregate_features(events(spark, sf_dir), specs, "user_id", "event_date", day)
        sl.write_features(features, root, "user", day, buckets=("user_id", 8))
    return tidy(sl.side_by_side(spark, root, "user", "user_id", [EVENTS_RUN_DATE, "2024-01-30"]))


def _own(name: str, column, days: int | None = None) -> dict:
    return {"name": name, "column": column, "window_days": days}


@check(
    "own_feature",
    """WITH evt AS (SELECT *, CAST(ts AS DATE) AS event_date FROM events),
    s AS (SELECT DISTINCT user_id FROM evt),
    a AS (SELECT user_id, COUNT(*) AS n FROM evt GROUP BY user_id),
    w AS (SELECT user_id, ROUND(MAX(value) - MIN(value), 8) AS spread_7d, MAX(event_type) AS last_type_7d,
        COUNT(DISTINCT event_type) AS types_7d FROM evt WHERE event_date >= DATE '2024-01-31' - 7 GROUP BY user_id)
    SELECT s.user_id, a.n, w.spread_7d, w.last_type_7d, COALESCE(w.types_7d, 0) AS types_7d
    FROM s LEFT JOIN a ON a.user_id = s.user_id LEFT JOIN w ON w.user_id = s.user_id""",
)
def own_feature(spark, sf_dir):
    """Features of the caller's over numbers, over text and over sets, beside a plain count."""
    spec = {
        "entity_type": "user",
        "aggregations": [agg("n", "event_id", "count")],
        "own": [
            _own("spread_7d", lambda r: F.max(r.value("value")) - F.min(r.value("value")), 7),
            _own("last_type_7d", lambda r: F.max(r.value("event_type")), 7),
            _own("types_7d", lambda r: F.size(F.collect_set(r.value("event_type"))).cast("bigint"), 7),
        ],
    }
    return tidy(sl.assemble_features(events(spark, sf_dir), [spec], "user_id", "event_date", EVENTS_RUN_DATE))


# What the states hold: everything of SPEND but its encoding, and some all-time features beside.
STATED = {
    **SPEND,
    "aggregations": [
        *SPEND["aggregations"],
        agg("spends", "event_id", "count"),
        agg("spend_mean", "value", "mean"),
        agg("spend_stddev", "value", "stddev"),
        agg("spend_stddev_14d", "value", "stddev", 14),
        agg("spend_min", "value", "min"),
    ],
    "encodings": [],
    "time_windows": [*SPEND["time_windows"], time("days_since_spend", "event_date", "days_diff")],
}


@check(
    "states_merged_by_era",
    with_views(
        joined(
            "evt_gaps",
            "user_id",
            [
                *[p for p in SPEND_PARTS if p.name != "spend_type_share"],
                Part("spends", "COUNT(event_id)", "spend", double=False),
                Part("spend_mean", "AVG(value)", "spend"),
                Part("spend_stddev", "STDDEV_SAMP(value)", "spend"),
                Part("spend_stddev_14d", "STDDEV_SAMP(value)", "spend", _since(14)),
                Part("spend_min", "MIN(value)", "spend"),
                Part("days_since_spend", "CAST(date_diff('day', MAX(event_date), DATE '2024-01-31') AS INTEGER)", "spend", double=False),
            ],
        ),
        "evt_gaps",
        spend=SPEND_VIEW,
    ),
)
def states_merged_by_era(spark, sf_dir):
    """The events arrive in three parts; each is reduced to its daily states, and days no window reaches are merged."""
    df = events_gaps(spark, sf_dir)
    first, second = F.lit("2024-01-11").cast("date"), F.lit("2024-01-22").cast("date")
    date = F.col("event_date")
    root, states = fresh_path(spark, "states"), None
    for day, part in (("2024-01-10", date < first), ("2024-01-21", (date >= first) & (date < second)), (EVENTS_RUN_DATE, date >= second)):
        more = sl.day_states(df.where(part), [STATED], "user_id", "event_date")
        both = more if states is None else states.unionByName(more)
        keep_from = dt.date.fromisoformat(day) - dt.timedelta(days=14)
        written = sl.write_features(sl.merge_states(both, [STATED], "user_id", keep_from), root, "user", day)
        states = spark.read.parquet(written.path)
    return tidy(sl.features_from_states(states, [STATED], "user_id", EVENTS_RUN_DATE))
