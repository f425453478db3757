"""Category maps and encodings, at the grain of the events and of the entities."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import spineloom as sl
from checks.fixtures import check, events_gaps, events_holes, orders_gaps, shipments, table, tidy, with_views


def map_sql(view: str, column: str) -> str:
    """category, n, share of all rows, label by descending count then name; a missing category comes last."""
    return (
        f"SELECT {column} AS category, COUNT(*) AS n, COUNT(*) / (SELECT COUNT(*) FROM {view}) AS share,"
        f" CAST(ROW_NUMBER() OVER (ORDER BY {column} IS NULL, COUNT(*) DESC, {column}) - 1 AS DOUBLE) AS label"
        f" FROM {view} GROUP BY {column}"
    )


def latest_sql(view: str, key: str, date: str, column: str) -> str:
    """Each entity with the category of its most recent row that has one."""
    return (
        f"SELECT s.{key}, l.category FROM (SELECT DISTINCT {key} FROM {view}) s LEFT JOIN (SELECT {key}, {column} AS"
        f" category FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {date} DESC NULLS LAST, {column} DESC)"
        f" AS nth FROM {view} WHERE {column} IS NOT NULL) WHERE nth = 1) l ON s.{key} = l.{key}"
    )


EVENT_MAP = map_sql("evt_holes", "event_type")
EVENT_LATEST = latest_sql("evt_holes", "user_id", "event_date", "event_type")
LABELS = "(SELECT COUNT(DISTINCT event_type) FROM evt_holes)"


def encoding(name: str, column: str, method: str) -> dict:
    return {"name": name, "source_column": column, "method": method}


def slots(df: DataFrame, key: str, name: str) -> DataFrame:
    """One row per slot of a one-hot array."""
    return df.select(key, F.posexplode_outer(name).alias("slot", "hot"))


@check("enc_frequency_map", with_views(f"SELECT category, n, ROUND(share, 8) AS share FROM ({EVENT_MAP})", "evt_holes"))
def enc_frequency_map(spark, sf_dir):
    return tidy(sl.category_map(events_holes(spark, sf_dir), "event_type").select("category", "n", "share"))


@check("enc_label_map", with_views(f"SELECT category, label FROM ({EVENT_MAP})", "evt_holes"))
def enc_label_map(spark, sf_dir):
    return sl.category_map(events_holes(spark, sf_dir), "event_type").select("category", "label")


@check(
    "enc_map_words",
    f"SELECT category, n, ROUND(share, 8) AS share, label FROM ({map_sql('documents', 'text')})",
)
def enc_map_words(spark, sf_dir):
    """Nearly every row a category of its own, each a whole text."""
    return tidy(sl.category_map(table(spark, sf_dir, "documents"), "text"))


@check(
    "enc_frequency_row",
    with_views(
        """SELECT e.user_id, ROUND(m.share, 8) AS type_share FROM evt_holes e LEFT JOIN m ON e.event_type = m.category
        WHERE e.user_id IS NOT NULL
        UNION ALL SELECT DISTINCT user_id, CAST(NULL AS DOUBLE) FROM evt_holes WHERE user_id IS NULL""",
        "evt_holes",
        m=EVENT_MAP,
    ),
)
def enc_frequency_row(spark, sf_dir):
    spec = encoding("type_share", "event_type", "frequency")
    return tidy(sl.encode_rows(events_holes(spark, sf_dir), spec, "user_id"))


@check(
    "enc_label_row",
    with_views(
        f"""SELECT e.user_id, COALESCE(m.label, {LABELS}) AS type_label
        FROM evt_holes e LEFT JOIN m ON e.event_type = m.category WHERE e.user_id IS NOT NULL
        UNION ALL SELECT DISTINCT user_id, CAST(NULL AS DOUBLE) FROM evt_holes WHERE user_id IS NULL""",
        "evt_holes",
        m=EVENT_MAP,
    ),
)
def enc_label_row(spark, sf_dir):
    return sl.encode_rows(events_holes(spark, sf_dir), encoding("type_label", "event_type", "label"), "user_id")


def slots_sql(rows: str) -> str:
    """``rows`` has user_id and label; a NULL label gives one row without slots."""
    return f"""SELECT r.user_id, CAST(s.slot AS INTEGER) AS slot,
            CASE WHEN s.slot = r.label THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS hot
        FROM ({rows}) r, (SELECT UNNEST(range({LABELS} + 1)) AS slot) s WHERE r.label IS NOT NULL
        UNION ALL SELECT user_id, NULL, NULL FROM ({rows}) WHERE label IS NULL"""


@check(
    "enc_onehot_row",
    with_views(
        slots_sql("SELECT * FROM coded"),
        "evt_holes",
        m=EVENT_MAP,
        coded=f"""SELECT e.user_id, COALESCE(m.label, {LABELS}) AS label
            FROM evt_holes e LEFT JOIN m ON e.event_type = m.category WHERE e.user_id IS NOT NULL
            UNION ALL SELECT DISTINCT user_id, NULL FROM evt_holes WHERE user_id IS NULL""",
    ),
)
def enc_onehot_row(spark, sf_dir):
    coded = sl.encode_rows(events_holes(spark, sf_dir), encoding("type_hot", "event_type", "onehot"), "user_id")
    return slots(coded, "user_id", "type_hot")


def entity_codes(spark, sf_dir, method: str) -> DataFrame:
    spec = encoding("code", "event_type", method)
    return sl.encode_entities(events_holes(spark, sf_dir), [spec], "user_id", "event_date")


@check(
    "enc_frequency_entity",
    with_views(
        """SELECT l.user_id, ROUND(CASE WHEN l.user_id IS NOT NULL THEN m.share END, 8) AS code
        FROM l LEFT JOIN m ON l.category = m.category""",
        "evt_holes",
        m=EVENT_MAP,
        l=EVENT_LATEST,
    ),
)
def enc_frequency_entity(spark, sf_dir):
    return tidy(entity_codes(spark, sf_dir, "frequency"))


@check(
    "enc_label_entity",
    with_views(
        f"""SELECT l.user_id, CASE WHEN l.user_id IS NOT NULL THEN COALESCE(m.label, {LABELS}) END AS code
        FROM l LEFT JOIN m ON l.category = m.category""",
        "evt_holes",
        m=EVENT_MAP,
        l=EVENT_LATEST,
    ),
)
def enc_label_entity(spark, sf_dir):
    return entity_codes(spark, sf_dir, "label")


@check(
    "enc_onehot_entity",
    with_views(
        slots_sql("SELECT * FROM coded"),
        "evt_holes",
        m=EVENT_MAP,
        l=EVENT_LATEST,
        coded=f"""SELECT l.user_id, CASE WHEN l.user_id IS NOT NULL THEN COALESCE(m.label, {LABELS}) END AS label
            FROM l LEFT JOIN m ON l.category = m.category""",
    ),
)
def enc_onehot_entity(spark, sf_dir):
    return slots(entity_codes(spark, sf_dir, "onehot"), "user_id", "code")


@check(
    "enc_onehot_vector",
    with_views(
        slots_sql("SELECT * FROM coded"),
        "evt_holes",
        m=EVENT_MAP,
        l=EVENT_LATEST,
        coded=f"""SELECT l.user_id, CASE WHEN l.user_id IS NOT NULL THEN COALESCE(m.label, {LABELS}) END AS label
            FROM l LEFT JOIN m ON l.category = m.category""",
    ),
)
def enc_onehot_vector(spark, sf_dir):
    """One-hot codes as sparse vectors."""
    spec = encoding("code", "event_type", "onehot")
    coded = sl.encode_entities(events_holes(spark, sf_dir), [spec], "user_id", "event_date", onehot="vector")
    return slots(coded.withColumn("code", F.when(F.col("code").isNotNull(), vector_to_array("code"))), "user_id", "code")


@check(
    "enc_multi_entity",
    with_views(
        """SELECT p.o_custkey, ROUND(mp.share, 8) AS priority_share,
            COALESCE(mp.label, (SELECT COUNT(DISTINCT o_orderpriority) FROM ord_gaps)) AS priority_label,
            ms.label AS status_label, ROUND(ms.share, 8) AS status_share
        FROM lp p LEFT JOIN ls s ON p.o_custkey = s.o_custkey
            LEFT JOIN mp ON p.category = mp.category LEFT JOIN ms ON s.category = ms.category""",
        "ord_gaps",
        mp=map_sql("ord_gaps", "o_orderpriority"),
        ms=map_sql("ord_gaps", "o_orderstatus"),
        lp=latest_sql("ord_gaps", "o_custkey", "order_date", "o_orderpriority"),
        ls=latest_sql("ord_gaps", "o_custkey", "order_date", "o_orderstatus"),
    ),
)
def enc_multi_entity(spark, sf_dir):
    specs = [
        encoding("priority_share", "o_orderpriority", "frequency"),
        encoding("priority_label", "o_orderpriority", "label"),
        encoding("status_label", "o_orderstatus", "label"),
        encoding("status_share", "o_orderstatus", "frequency"),
    ]
    return tidy(sl.encode_entities(orders_gaps(spark, sf_dir), specs, "o_custkey", "order_date"))


@check(
    "enc_timestamp_order",
    with_views(
        """SELECT l.user_id, CASE WHEN l.user_id IS NOT NULL THEN m.label END AS type_label
        FROM l LEFT JOIN m ON l.category = m.category""",
        "evt_gaps",
        m=map_sql("evt_gaps", "event_type"),
        l=latest_sql("evt_gaps", "user_id", "ts", "event_type"),
    ),
)
def enc_timestamp_order(spark, sf_dir):
    """With a timestamp as date column the latest event is exact to the microsecond."""
    spec = encoding("type_label", "event_type", "label")
    return sl.encode_entities(events_gaps(spark, sf_dir), [spec], "user_id", "ts")


@check(
    "enc_label_row_large",
    f"SELECT l.l_orderkey, m.label AS part_label FROM lineitem l JOIN ({map_sql('lineitem', 'l_partkey::VARCHAR')}) m"
    " ON l.l_partkey::VARCHAR = m.category",
)
def enc_label_row_large(spark, sf_dir):
    """Far more categories than a literal map holds."""
    return sl.encode_rows(table(spark, sf_dir, "lineitem"), encoding("part_label", "l_partkey", "label"), "l_orderkey")


@check(
    "enc_frequency_long_names",
    f"SELECT d.doc_id, ROUND(m.share, 8) AS text_share FROM documents d JOIN ({map_sql('documents', 'text')}) m"
    " ON d.text = m.category",
)
def enc_frequency_long_names(spark, sf_dir):
    """Whole texts as categories: their names are never broadcast."""
    spec = encoding("text_share", "text", "frequency")
    return tidy(sl.encode_rows(table(spark, sf_dir, "documents"), spec, "doc_id"))


@check(
    "enc_multi_entity_large",
    with_views(
        """SELECT p.l_suppkey, mp.label AS part_label, mo.label AS order_label, ROUND(md.share, 8) AS day_share
        FROM lp p JOIN lo o ON p.l_suppkey = o.l_suppkey JOIN ld d ON p.l_suppkey = d.l_suppkey
            JOIN mp ON p.category = mp.category JOIN mo ON o.category = mo.category JOIN md ON d.category = md.category""",
        "ship",
        texts="""SELECT l_suppkey, ship_date, CAST(l_partkey AS VARCHAR) AS part, CAST(l_orderkey AS VARCHAR) AS ord,
            CAST(ship_date AS VARCHAR) AS day FROM ship""",
        **{f"m{c[0]}": map_sql("texts", c) for c in ("part", "ord", "day")},
        **{f"l{c[0]}": latest_sql("texts", "l_suppkey", "ship_date", c) for c in ("part", "ord", "day")},
    ),
)
def enc_multi_entity_large(spark, sf_dir):
    """Three attributes of many categories each."""
    specs = [
        encoding("part_label", "l_partkey", "label"),
        encoding("order_label", "l_orderkey", "label"),
        encoding("day_share", "ship_date", "frequency"),
    ]
    return tidy(sl.encode_entities(shipments(spark, sf_dir), specs, "l_suppkey", "ship_date"))
