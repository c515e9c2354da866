"""ANSI SQL that states each query independently, for a second engine to run.

Every statement is written from the meaning of the result (naive joins and global
windows), not from the plan the Spark query uses.
"""

from __future__ import annotations

import re

from orderlens.operators.contract import RULES
from orderlens.plans.catalog import AUDIT_DATE, RUN, SCAN_PATTERNS

CLASSES = RUN.categories
_COLUMNS = (
    "order_id, customer_id, order_date, category, order_value, contribution_margin, "
    "used_discount, acquisition_channel, region"
)
_DAY = f"DATE '{RUN.scoring_date}'"


def _values(names) -> str:
    return ", ".join(f"({index}, '{name}')" for index, name in enumerate(names))


def _class_case(column: str) -> str:
    return f"list_position([{', '.join(repr(c) for c in CLASSES)}], {column})"


def _snapshot_ctes(prefix: str, grid: str) -> dict[str, str]:
    """History, features and labels for the score dates of ``grid``."""
    wide = ",\n".join(
        f"count(*) FILTER (category = '{c}') AS {c.lower()}_orders_365d, "
        f"count(*) FILTER (category = '{c}') / CAST(count(*) AS DOUBLE) "
        f"AS {c.lower()}_share_365d, "
        f"coalesce(score_date - max(order_date) FILTER (category = '{c}'), 400) "
        f"AS {c.lower()}_recency_days"
        for c in CLASSES
    )
    return {
        f"{prefix}hist": f"""
            SELECT t.*, g.score_date,
                row_number() OVER (PARTITION BY customer_id, g.score_date
                    ORDER BY order_date DESC, order_id DESC) AS back,
                order_date - lag(order_date) OVER (PARTITION BY customer_id, g.score_date
                    ORDER BY order_date, order_id) AS gap
            FROM tx t JOIN {grid} g ON t.order_date < g.score_date""",
        f"{prefix}life": f"""
            SELECT customer_id, score_date, count(*) AS orders_lifetime,
                score_date - min(order_date) AS customer_tenure_days,
                score_date - max(order_date) AS recency_days,
                coalesce(median(gap) FILTER (back <= 8), 90.0) AS average_gap_days,
                coalesce(stddev_pop(gap) FILTER (back <= 8), 0.0) AS gap_variability_days,
                max(acquisition_channel) FILTER (back = 1) AS acquisition_channel,
                max(region) FILTER (back = 1) AS region,
                max(category) FILTER (back = 1) AS last_category,
                max(order_value) FILTER (back = 1) AS last_order_value,
                max(contribution_margin) FILTER (back = 1) AS last_order_margin
            FROM {prefix}hist GROUP BY customer_id, score_date
            HAVING count(*) >= 3 AND score_date - max(order_date) <= 365""",
        f"{prefix}year": f"""
            SELECT customer_id, score_date, count(*) AS orders_365d,
                count(*) FILTER (order_date >= score_date - 90) AS orders_90d,
                count(*) FILTER (order_date >= score_date - 30) AS orders_30d,
                CAST(sum(CAST(order_value AS DECIMAL(18,2))) AS DOUBLE) / count(*)
                    AS average_order_value_365d,
                CAST(sum(CAST(contribution_margin AS DECIMAL(18,2))) AS DOUBLE)
                    AS total_margin_365d,
                CAST(sum(used_discount) AS DOUBLE) / count(*) AS discount_share_365d,
                CAST(count(*) FILTER (isodow(order_date) >= 6) AS DOUBLE) / count(*)
                    AS weekend_share_365d,
                count(DISTINCT category) AS category_diversity_365d,
                {wide}
            FROM {prefix}hist WHERE order_date >= score_date - 365
            GROUP BY customer_id, score_date""",
        f"{prefix}bycat": f"""
            SELECT customer_id, score_date, category, count(*) AS orders,
                max(order_date) AS last_date, min(order_date || order_id) AS first_seen
            FROM {prefix}hist WHERE order_date >= score_date - 365
            GROUP BY customer_id, score_date, category""",
        f"{prefix}fav": f"""
            SELECT customer_id, score_date, category AS favorite_category, orders
            FROM {prefix}bycat QUALIFY row_number() OVER (
                PARTITION BY customer_id, score_date ORDER BY orders DESC, first_seen) = 1""",
        f"{prefix}feat": f"""
            SELECT l.*, y.* EXCLUDE (customer_id, score_date), f.favorite_category,
                f.orders / CAST(y.orders_365d AS DOUBLE) AS favorite_category_share_365d,
                y.orders_90d / greatest(y.orders_365d / 4.0::DOUBLE, 0.25::DOUBLE)
                    AS order_momentum,
                l.recency_days / greatest(l.average_gap_days, 7.0::DOUBLE) AS cadence_progress,
                CASE WHEN l.customer_tenure_days <= 150 AND l.orders_lifetime <= 4 THEN 'New'
                    WHEN l.recency_days > greatest(60.0::DOUBLE, 1.5 * l.average_gap_days)
                        THEN 'At Risk'
                    WHEN y.orders_90d >= 3 THEN 'Loyal' ELSE 'Growing' END AS lifecycle_segment,
                CAST(month(l.score_date) AS BIGINT) AS score_month,
                CAST(quarter(l.score_date) AS BIGINT) AS score_quarter
            FROM {prefix}life l JOIN {prefix}year y USING (customer_id, score_date)
            JOIN {prefix}fav f USING (customer_id, score_date)""",
    }


_TRAIN = f"score_date < DATE '{RUN.validation_start}'"
_VALIDATION = (
    f"score_date >= DATE '{RUN.validation_start}' AND score_date < DATE '{RUN.test_start}'"
)
_TEST = f"score_date >= DATE '{RUN.test_start}'"


def _shares(prefix: str, source: str, label: str) -> dict[str, str]:
    """Class shares among the labels of ``source``."""
    return {
        f"{prefix}pop": f"""
            SELECT c.idx, c.category, count(s.{label}) AS orders,
                CAST(count(s.{label}) AS DOUBLE) / sum(count(s.{label})) OVER () AS share
            FROM classes c LEFT JOIN ({source}) s ON s.{label} = c.category
            GROUP BY c.idx, c.category"""
    }


def _scored(prefix: str, rows: str) -> dict[str, str]:
    """Long class probabilities of both baselines with ranks, for labeled ``rows``."""
    return {
        f"{prefix}weight": f"""
            SELECT r.customer_id, r.score_date, r.next_category, r.last_category, p.idx,
                p.category, p.share,
                0.35::DOUBLE * p.share
                    + CASE WHEN p.category = r.last_category THEN 0.65::DOUBLE
                        ELSE 0.0::DOUBLE END AS weight
            FROM ({rows}) r CROSS JOIN {prefix}pop p""",
        f"{prefix}prob": f"""
            SELECT *, weight / sum(weight) OVER (PARTITION BY customer_id, score_date) AS blend
            FROM {prefix}weight""",
        f"{prefix}long": f"""
            SELECT *,
                row_number() OVER (PARTITION BY customer_id, score_date
                    ORDER BY weight DESC, idx) AS blend_rank,
                row_number() OVER (PARTITION BY customer_id, score_date
                    ORDER BY share DESC, idx) AS share_rank
            FROM {prefix}prob""",
    }


def _ranking_select(prefix: str, p: str, rank: str, extra: str = "") -> str:
    return f"""{extra}
        round(avg(CASE WHEN {rank} <= 1 THEN 1.0 ELSE 0.0 END)
            FILTER (category = next_category), 6) AS top_1_hit_rate,
        round(avg(CASE WHEN {rank} <= 2 THEN 1.0 ELSE 0.0 END)
            FILTER (category = next_category), 6) AS top_2_hit_rate,
        round(avg(CASE WHEN {rank} <= 3 THEN 1.0 ELSE 0.0 END)
            FILTER (category = next_category), 6) AS top_3_hit_rate,
        round(avg(1.0::DOUBLE / {rank}) FILTER (category = next_category), 6)
            AS mean_reciprocal_rank,
        round(avg(-ln(greatest(least({p}, 1 - pow(2.0::DOUBLE, -52)), pow(2.0::DOUBLE, -52))))
            FILTER (category = next_category), 6) AS log_loss,
        round(sum(pow({p} - CASE WHEN category = next_category THEN 1.0::DOUBLE ELSE 0.0::DOUBLE
            END, 2)) / count(*) FILTER (category = next_category), 6) AS multiclass_brier_score
        FROM {prefix}long"""


_SCORED_ROWS = "SELECT * FROM snap WHERE next_category IS NOT NULL AND "
_TRAIN_LABELS = f"SELECT next_category FROM snap WHERE {_TRAIN}"

CTES: dict[str, str] = {
    "lead_line": """
        SELECT l_orderkey, l_partkey, l_discount FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC,
            l_partkey, l_linenumber, l_suppkey) = 1""",
    "order_money": """
        SELECT l_orderkey,
            CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,2))
                * (1 - CAST(l_discount AS DECIMAL(4,2)))), 2) AS DOUBLE) AS order_value,
            CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,2))
                * (CAST(0.15 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))), 2) AS DOUBLE)
                AS contribution_margin
        FROM lineitem GROUP BY l_orderkey""",
    "tx": """
        SELECT o_orderkey AS order_key,
            'O' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS order_id,
            'C' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS customer_id,
            CAST(o_orderdate AS DATE) AS order_date, p_type AS category, order_value,
            contribution_margin,
            CAST(CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS BIGINT) AS used_discount,
            c_mktsegment AS acquisition_channel, r_name AS region
        FROM orders JOIN lead_line ON o_orderkey = lead_line.l_orderkey
        JOIN order_money ON o_orderkey = order_money.l_orderkey
        JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "dirty": """
        SELECT order_key AS k,
            CASE WHEN order_key % 131 = 0
                THEN 'O' || lpad(CAST(order_key - 1 AS VARCHAR), 10, '0')
                ELSE order_id END AS order_id,
            CASE WHEN order_key % 101 = 0 THEN '=' ELSE '' END || customer_id AS customer_id,
            CASE WHEN order_key % 103 = 0 THEN CAST(order_date AS VARCHAR) || ' 10:30:00'
                WHEN order_key % 107 = 0 THEN '2001-02-30'
                ELSE CAST(order_date AS VARCHAR) END AS order_date,
            CASE WHEN order_key % 97 = 0 THEN '' WHEN order_key % 137 = 0 THEN lower(category)
                ELSE category END AS category,
            CASE WHEN order_key % 109 = 0 THEN '-' ELSE '' END
                || CAST(CAST(order_value AS DECIMAL(18,2)) AS VARCHAR) AS order_value,
            CASE WHEN order_key % 113 = 0 THEN 'abc'
                ELSE CAST(CAST(contribution_margin AS DECIMAL(18,2)) AS VARCHAR) END
                AS contribution_margin,
            CASE WHEN order_key % 127 = 0 THEN '2' ELSE CAST(used_discount AS VARCHAR) END
                AS used_discount,
            acquisition_channel,
            CASE WHEN order_key % 139 <> 0 THEN region END AS region
        FROM tx""",
    "repeated": """
        SELECT order_id, count(*) AS copies FROM dirty GROUP BY order_id HAVING count(*) > 1""",
    "labels_seen": """
        SELECT lower(category) AS folded, category, count(*) AS orders FROM dirty
        GROUP BY lower(category), category""",
    "clash": """
        SELECT *, row_number() OVER (PARTITION BY folded ORDER BY orders DESC, category) = 1
            AS kept
        FROM labels_seen WHERE folded IN (
            SELECT folded FROM labels_seen GROUP BY folded HAVING count(*) > 1)""",
    "flags": """
        SELECT d.*, d.region IS NULL AS required_not_null,
            d.category = '' AS category_not_blank,
            k % 101 = 0 AS customer_id_no_formula_prefix,
            r.order_id IS NOT NULL AS order_id_unique,
            d.category IN (SELECT category FROM clash WHERE NOT kept)
                AS category_unique_after_folding,
            k % 103 = 0 AS order_date_format,
            k % 107 = 0 AND k % 103 <> 0 AS order_date_valid,
            k % 113 = 0 AS contribution_margin_finite,
            CAST(d.order_value AS DOUBLE) < 0 AS order_value_not_negative,
            k % 127 = 0 AS used_discount_binary
        FROM dirty d LEFT JOIN repeated r ON d.order_id = r.order_id""",
    "grid": f"""
        SELECT CAST(DATE '{RUN.snapshot_start}'
            + CAST({RUN.snapshot_frequency_days} * i AS INTEGER) AS DATE) AS score_date
        FROM range({RUN.last_grid_index() + 1}) r(i)
        WHERE DATE '{RUN.snapshot_start}'
            + CAST({RUN.snapshot_frequency_days} * i + {RUN.target_horizon_days} AS INTEGER)
            <= (SELECT max(order_date) FROM tx)""",
    "scoring_day": f"SELECT {_DAY} AS score_date",
    **_snapshot_ctes("g_", "grid"),
    **_snapshot_ctes("d_", "scoring_day"),
    "nextorder": """
        SELECT l.customer_id, l.score_date, t.category, t.order_date - l.score_date AS days
        FROM g_life l JOIN tx t
            ON t.customer_id = l.customer_id AND t.order_date >= l.score_date
        QUALIFY row_number() OVER (PARTITION BY l.customer_id, l.score_date
            ORDER BY t.order_date, t.order_id) = 1""",
    "snap": """
        SELECT f.*,
            CAST(CASE WHEN n.days <= 30 THEN 1 ELSE 0 END AS BIGINT) AS purchase_within_30d,
            CASE WHEN n.days <= 60 THEN n.category END AS next_category,
            CASE WHEN n.days <= 60 THEN n.days END AS days_to_next_purchase
        FROM g_feat f LEFT JOIN nextorder n USING (customer_id, score_date)""",
    "classes": f"SELECT * FROM (VALUES {_values(CLASSES)}) v(idx, category)",
    **_shares("v_", _TRAIN_LABELS, "next_category"),
    **_scored("v_", _SCORED_ROWS + _VALIDATION),
    **_shares(
        "t_", f"SELECT next_category FROM snap WHERE NOT ({_TEST})", "next_category"
    ),
    **_scored("t_", _SCORED_ROWS + _TEST),
    **_shares("h_", f"SELECT category AS label FROM tx WHERE order_date < {_DAY}", "label"),
    "ready": """
        SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(2.1::DOUBLE * (cadence_progress - 0.75)
            + 0.25::DOUBLE * greatest(-2.0::DOUBLE, least(2.0::DOUBLE, order_momentum - 1.0)))))
            AS readiness
        FROM snap""",
    "vready": f"""
        SELECT customer_id, score_date, purchase_within_30d, round(readiness, 9) AS readiness
        FROM ready WHERE {_VALIDATION}""",
    "curve": """
        SELECT readiness, count(*) AS n, sum(purchase_within_30d) AS pos FROM vready
        GROUP BY readiness""",
    "steps": """
        SELECT *, sum(n) OVER (ORDER BY readiness DESC) AS cum_n,
            sum(pos) OVER (ORDER BY readiness DESC) AS cum_pos FROM curve""",
    "ap": """
        SELECT sum(CAST(pos AS DOUBLE) * cum_pos / cum_n) / sum(pos) AS average_precision
        FROM steps""",
    "auc": """
        SELECT sum(CAST(pos AS DOUBLE)
            * ((SELECT sum(n - pos) FROM curve) - (cum_n - cum_pos) + (n - pos) / 2.0::DOUBLE))
            / (CAST(sum(pos) AS DOUBLE) * sum(n - pos)) AS roc_auc FROM steps""",
    "calib": """
        SELECT avg(pow(readiness - purchase_within_30d, 2)) AS brier_score,
            avg(-ln(greatest(least(CASE WHEN purchase_within_30d = 1 THEN readiness
                ELSE 1.0::DOUBLE - readiness END, 1 - pow(2.0::DOUBLE, -52)),
                pow(2.0::DOUBLE, -52)))) AS log_loss FROM vready""",
    "placed": """
        SELECT purchase_within_30d AS y,
            row_number() OVER (ORDER BY readiness DESC, score_date, customer_id) AS place,
            greatest(1, CAST(ceil(0.2::DOUBLE * count(*) OVER ()) AS BIGINT)) AS wanted
        FROM vready""",
    "topshare": """
        SELECT CAST(sum(y) FILTER (place <= wanted) AS DOUBLE) / sum(y) AS recall_at_top_20pct,
            (CAST(sum(y) FILTER (place <= wanted) AS DOUBLE) / max(wanted))
                / (CAST(sum(y) AS DOUBLE) / count(*)) AS lift_at_top_20pct FROM placed""",
    "mready": """
        SELECT *, CAST(date_trunc('month', score_date) AS DATE) AS score_month FROM vready""",
    "mcurve": """
        SELECT score_month, readiness, count(*) AS n, sum(purchase_within_30d) AS pos FROM mready
        GROUP BY score_month, readiness""",
    "msteps": """
        SELECT *, sum(n) OVER (PARTITION BY score_month ORDER BY readiness DESC) AS cum_n,
            sum(pos) OVER (PARTITION BY score_month ORDER BY readiness DESC) AS cum_pos,
            sum(n - pos) OVER (PARTITION BY score_month) AS negatives
        FROM mcurve""",
    "mplaced": """
        SELECT score_month, purchase_within_30d AS y,
            row_number() OVER (PARTITION BY score_month
                ORDER BY readiness DESC, score_date, customer_id) AS place,
            greatest(1, CAST(ceil(0.2::DOUBLE * count(*) OVER (PARTITION BY score_month))
                AS BIGINT)) AS wanted
        FROM mready""",
    "mcapacity": """
        SELECT score_month,
            coalesce(CAST(sum(y) FILTER (place <= wanted) AS DOUBLE) / nullif(sum(y), 0), 0)
                AS recall_at_top_20pct,
            coalesce((CAST(sum(y) FILTER (place <= wanted) AS DOUBLE) / max(wanted))
                / (CAST(nullif(sum(y), 0) AS DOUBLE) / count(*)), 0) AS lift_at_top_20pct
        FROM mplaced GROUP BY score_month""",
    "mdiscrimination": """
        SELECT score_month,
            coalesce(sum(CAST(pos AS DOUBLE) * cum_pos / cum_n) / nullif(sum(pos), 0), 0)
                AS average_precision,
            sum(CAST(pos AS DOUBLE) * (negatives - (cum_n - cum_pos) + (n - pos) / 2.0::DOUBLE))
                / nullif(CAST(sum(pos) AS DOUBLE) * sum(n - pos), 0) AS roc_auc
        FROM msteps GROUP BY score_month""",
    "mcalibration": """
        SELECT score_month, count(*) AS snapshots,
            avg(pow(readiness - purchase_within_30d, 2)) AS brier_score,
            avg(-ln(greatest(least(CASE WHEN purchase_within_30d = 1 THEN readiness
                ELSE 1.0::DOUBLE - readiness END, 1 - pow(2.0::DOUBLE, -52)),
                pow(2.0::DOUBLE, -52)))) AS log_loss,
            avg(readiness) AS average_score,
            avg(CAST(purchase_within_30d AS DOUBLE)) AS observed_rate
        FROM mready GROUP BY score_month""",
    "mmetrics": """
        SELECT score_month, snapshots, round(average_precision, 6) AS average_precision,
            round(roc_auc, 6) AS roc_auc, round(brier_score, 6) AS brier_score,
            round(log_loss, 6) AS log_loss, round(recall_at_top_20pct, 6) AS recall_at_top_20pct,
            round(lift_at_top_20pct, 6) AS lift_at_top_20pct,
            round(average_score, 6) AS average_score, round(observed_rate, 6) AS observed_rate,
            round(average_score - observed_rate, 6) AS calibration_gap
        FROM mcalibration JOIN mdiscrimination USING (score_month)
            JOIN mcapacity USING (score_month)""",
    "cmetrics": _ranking_select(
        "v_",
        "blend",
        "blend_rank",
        "SELECT CAST(date_trunc('month', score_date) AS DATE) AS score_month, "
        "count(*) FILTER (category = next_category) AS snapshots,",
    )
    + " GROUP BY 1",
    "stacked": " UNION ALL ".join(
        f"SELECT '{task}' AS task, '{metric}' AS metric, {sign} AS sign, snapshots AS w, "
        f"date_diff('month', min(score_month) OVER (), score_month) AS x, {metric} AS y "
        f"FROM {table}"
        for task, table, metric, sign in (
            ("purchase_readiness_30d", "mmetrics", "average_precision", 1),
            ("purchase_readiness_30d", "mmetrics", "roc_auc", 1),
            ("purchase_readiness_30d", "mmetrics", "lift_at_top_20pct", 1),
            ("purchase_readiness_30d", "mmetrics", "brier_score", -1),
            ("next_category", "cmetrics", "top_3_hit_rate", 1),
            ("next_category", "cmetrics", "mean_reciprocal_rank", 1),
            ("next_category", "cmetrics", "log_loss", -1),
        )
    ),
    "fitted_line": """
        SELECT task, metric, sign, count(*) AS months, arg_min(y, x) AS first_value,
            arg_max(y, x) AS last_value, max(x) - min(x) AS span,
            sum(w * (x - mx) * (y - my)) / sum(w * (x - mx) * (x - mx)) AS slope
        FROM (SELECT *, sum(w * x) OVER of_metric / sum(w) OVER of_metric AS mx,
                sum(w * y) OVER of_metric / sum(w) OVER of_metric AS my
            FROM (SELECT task, metric, sign, CAST(w AS DOUBLE) AS w, CAST(x AS DOUBLE) AS x, y
                FROM stacked WHERE y IS NOT NULL)
            WINDOW of_metric AS (PARTITION BY task, metric))
        GROUP BY task, metric, sign""",
    "margin": f"""
        SELECT category, median(contribution_margin) AS expected_category_margin FROM tx
        WHERE order_date < {_DAY} GROUP BY category""",
    "q_weight": """
        SELECT f.customer_id, f.score_date, p.idx, p.category,
            0.35::DOUBLE * p.share + CASE WHEN p.category = f.last_category THEN 0.65::DOUBLE
                ELSE 0.0::DOUBLE END AS weight,
            1.0::DOUBLE / (1.0::DOUBLE + exp(-(2.1::DOUBLE * (f.cadence_progress - 0.75)
                + 0.25::DOUBLE * greatest(-2.0::DOUBLE,
                    least(2.0::DOUBLE, f.order_momentum - 1.0))))) AS readiness
        FROM d_feat f CROSS JOIN h_pop p""",
    "q_prob": """
        SELECT *, weight / sum(weight) OVER (PARTITION BY customer_id) AS p,
            row_number() OVER (PARTITION BY customer_id ORDER BY weight DESC, idx) AS place
        FROM q_weight""",
    "top3": """
        SELECT customer_id, score_date, max(readiness) AS purchase_readiness_30d,
            max(category) FILTER (place = 1) AS recommended_category,
            max(p) FILTER (place = 1) AS category_probability,
            max(category) FILTER (place = 2) AS second_category,
            max(category) FILTER (place = 3) AS third_category
        FROM q_prob GROUP BY customer_id, score_date""",
    "action": """
        SELECT t.*, m.expected_category_margin,
            purchase_readiness_30d * category_probability * expected_category_margin
                AS action_score
        FROM top3 t JOIN margin m ON m.category = t.recommended_category""",
    "ranked": """
        SELECT *, row_number() OVER (ORDER BY action_score DESC, purchase_readiness_30d DESC,
            customer_id) AS queue_rank, count(*) OVER () AS n FROM action""",
    "queue": """
        SELECT * EXCLUDE (n), CASE WHEN queue_rank / CAST(n AS DOUBLE) <= 0.15::DOUBLE
            THEN 'Priority' WHEN queue_rank / CAST(n AS DOUBLE) <= 0.40::DOUBLE THEN 'Review'
            ELSE 'Monitor' END AS capacity_tier FROM ranked""",
    "recall": """
        SELECT c.category, count(l.idx) AS support,
            avg(CASE WHEN l.idx IS NULL THEN NULL WHEN l.blend_rank = 1 THEN 1.0 ELSE 0.0 END)
                AS top_1_recall,
            avg(CASE WHEN l.idx IS NULL THEN NULL WHEN l.blend_rank <= 3 THEN 1.0 ELSE 0.0 END)
                AS top_3_recall
        FROM classes c LEFT JOIN v_long l
            ON l.next_category = c.category AND l.category = l.next_category
        GROUP BY c.category""",
    "digests": """
        SELECT sha256(concat_ws(chr(31), order_id, customer_id, CAST(order_date AS VARCHAR),
            category, CAST(CAST(order_value AS DECIMAL(18,2)) AS VARCHAR),
            CAST(CAST(contribution_margin AS DECIMAL(18,2)) AS VARCHAR),
            CAST(used_discount AS VARCHAR), acquisition_channel, region)) AS digest
        FROM tx""",
    "man": """
        SELECT c_custkey AS k, c_custkey % 31 <> 0 AS ok, c_custkey % 13 = 0 AS blank
        FROM customer""",
    "scanned": "SELECT doc_id, source, lang, text FROM documents",
}


def _statement(final: str) -> str:
    """Prefix ``final`` with the common table expressions it needs, in order."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                needed.add(name)
                visit(CTES[name])

    visit(final)
    if not needed:
        return final
    parts = ",\n".join(f"{name} AS ({CTES[name]})" for name in CTES if name in needed)
    return f"WITH {parts}\n{final}"


def _rounded(*names: str) -> str:
    return ", ".join(f"round(CAST({name} AS DOUBLE), 6) AS {name}" for name in names)


_SNAPSHOT_DOUBLES = {
    "order_momentum",
    "average_order_value_365d",
    "total_margin_365d",
    "discount_share_365d",
    "weekend_share_365d",
    "favorite_category_share_365d",
    "average_gap_days",
    "gap_variability_days",
    "cadence_progress",
    "last_order_value",
    "last_order_margin",
    *[f"{c.lower()}_share_365d" for c in CLASSES],
}
_WIDE = [
    f"{c.lower()}_{kind}"
    for c in CLASSES
    for kind in ("orders_365d", "share_365d", "recency_days")
]
_FEATURES = [
    "acquisition_channel",
    "region",
    "lifecycle_segment",
    "last_category",
    "favorite_category",
    "customer_tenure_days",
    "recency_days",
    "orders_lifetime",
    "orders_365d",
    "orders_90d",
    "orders_30d",
    "order_momentum",
    "average_order_value_365d",
    "total_margin_365d",
    "discount_share_365d",
    "weekend_share_365d",
    "category_diversity_365d",
    "favorite_category_share_365d",
    "average_gap_days",
    "gap_variability_days",
    "cadence_progress",
    "last_order_value",
    "last_order_margin",
    "score_month",
    "score_quarter",
    *_WIDE,
]
_LABELS = ["purchase_within_30d", "next_category", "days_to_next_purchase"]


def _snapshot(names: list[str], table: str = "snap") -> str:
    shown = [_rounded(n) if n in _SNAPSHOT_DOUBLES else n for n in names]
    return f"SELECT {', '.join(['customer_id', 'score_date', *shown])} FROM {table}"


_SUMMARY = """count(*) AS customers, round(avg(purchase_readiness_30d), 6) AS average_readiness,
    round(avg(category_probability), 6) AS average_category_probability,
    round(avg(action_score), 6) AS average_action_score"""
_QUEUE = (
    "customer_id, score_date, recommended_category, "
    + _rounded(
        "category_probability",
        "purchase_readiness_30d",
        "expected_category_margin",
        "action_score",
    )
    + ", second_category, third_category, capacity_tier, queue_rank"
)
_LABEL_FIELDS = ("order_id", "customer_id", "category", "acquisition_channel", "region")
_VIOLATED = [r for r in RULES if f" AS {r}" in CTES["flags"]]
_VIOLATIONS = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {rule} THEN '{rule}' END" for rule in _VIOLATED
) + ")"


def _issue_rows() -> str:
    parts = [
        f"SELECT order_id, '{field}' AS field, {field} AS cleaned, "
        f"CASE WHEN {field} IS NULL OR {field} = '' THEN 'blank' "
        f"WHEN regexp_matches({field}, '^[=+@-]') THEN 'formula_prefix' END AS issue FROM dirty"
        for field in (*_LABEL_FIELDS, "order_date")
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE issue IS NOT NULL"


def _report() -> str:
    parts = []
    for position, rule in enumerate(RULES, start=1):
        if rule == "order_id_unique":
            count = "(SELECT CAST(coalesce(sum(copies), 0) AS BIGINT) FROM repeated)"
        elif rule == "category_unique_after_folding":
            count = "(SELECT count(*) - count(DISTINCT folded) FROM labels_seen)"
        elif rule in _VIOLATED:
            count = f"(SELECT count(*) FILTER ({rule}) FROM flags)"
        else:
            count = "CAST(0 AS BIGINT)"
        parts.append(
            f"SELECT CAST({position} AS BIGINT) AS position, '{rule}' AS rule, "
            f"{count} AS violations"
        )
    return " UNION ALL ".join(parts)


def _provenance() -> str:
    """Failures by rule, from the moduli that produced the defects."""
    named_prefix = "k % 17 = 0 AND NOT blank"
    failed = [
        ("valid_json_object", "NOT ok"),
        ("all_fields_present", "NOT ok OR k % 19 = 0"),
        ("schema_version_supported", "NOT ok OR k % 11 = 0"),
        ("source_name_not_blank", "NOT ok OR blank"),
        ("source_name_no_formula_prefix", f"NOT ok OR ({named_prefix})"),
        ("source_type_not_blank", "NOT ok"),
        ("source_type_no_formula_prefix", "NOT ok"),
        ("license_or_authorization_not_blank", "NOT ok OR k % 19 = 0"),
        ("license_or_authorization_no_formula_prefix", "NOT ok OR k % 19 = 0"),
        ("identifiers_pseudonymized", "NOT ok OR k % 23 = 0"),
        ("no_direct_identifiers", "NOT ok OR k % 29 = 0"),
    ]
    return " UNION ALL ".join(
        f"SELECT CAST({position} AS BIGINT) AS position, '{rule}' AS rule, "
        f"count(*) AS manifests, count(*) FILTER ({bad}) AS failed FROM man"
        for position, (rule, bad) in enumerate(failed, start=1)
    )


def _scan(groups: list[str]) -> str:
    parts = []
    for label, pattern in SCAN_PATTERNS.items():
        text = pattern.replace("'", "''")
        parts.append(
            f"SELECT {', '.join(groups)}, '{label}' AS label FROM scanned "
            f"WHERE regexp_matches(text, '{text}')"
        )
    return " UNION ALL ".join(parts)


def _both_baselines(prefix: str) -> str:
    popular = _ranking_select(prefix, "share", "share_rank", "SELECT 'popularity_baseline' "
                              "AS candidate,")
    blended = _ranking_select(prefix, "blend", "blend_rank", "SELECT 'last_category_baseline' "
                              "AS candidate,")
    return f"{popular} UNION ALL {blended}"


_RANKING = _ranking_select("v_", "blend", "blend_rank", "SELECT")
_BINARY = (
    "SELECT "
    + _rounded(
        "average_precision",
        "roc_auc",
        "brier_score",
        "log_loss",
        "recall_at_top_20pct",
        "lift_at_top_20pct",
    )
    + " FROM ap, auc, calib, topshare"
)

FINALS: dict[str, str] = {
    "scan_transactions": f"SELECT {_COLUMNS} FROM tx",
    "contract_projection": f"SELECT {_COLUMNS} FROM tx",
    "contract_identifiers": _issue_rows(),
    "contract_violations": " UNION ALL ".join(
        f"SELECT '{c.strip()}' AS field, count(*) FILTER ({c.strip()} IS NULL) AS nulls FROM dirty"
        for c in _COLUMNS.split(",")
    ),
    "contract_duplicate_orders": "SELECT order_id, copies FROM repeated",
    "contract_category_casefold": "SELECT folded, category, orders, kept FROM clash",
    "contract_dates": """
        SELECT order_id, order_date, CASE WHEN shaped THEN 'invalid_day' ELSE 'format' END AS issue
        FROM (SELECT *, regexp_full_match(order_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AS shaped
            FROM dirty)
        WHERE NOT shaped OR try_cast(order_date AS DATE) IS NULL""",
    "contract_numerics": """
        SELECT * FROM (
            SELECT order_id, field, "text", CASE WHEN "text" IS NULL THEN 'missing'
                WHEN number IS NULL OR NOT isfinite(number) THEN 'not_finite'
                WHEN field = 'order_value' AND number < 0 THEN 'negative'
                WHEN field = 'used_discount' AND number NOT IN (0, 1) THEN 'not_binary' END AS issue
            FROM (SELECT order_id, field, "text", try_cast("text" AS DOUBLE) AS number
                FROM (SELECT order_id, 'order_value' AS field, CAST(order_value AS VARCHAR) AS "text"
                        FROM dirty
                    UNION ALL SELECT order_id, 'contribution_margin',
                        CAST(contribution_margin AS VARCHAR) FROM dirty
                    UNION ALL SELECT order_id, 'used_discount', CAST(used_discount AS VARCHAR)
                        FROM dirty)))
        WHERE issue IS NOT NULL""",
    "contract_report": _report(),
    "contract_quarantine": f"SELECT {_COLUMNS}, {_VIOLATIONS} AS violations FROM flags",
    "contract_accepted": f"""SELECT order_id, customer_id, CAST(order_date AS DATE) AS order_date,
        category, CAST(order_value AS DOUBLE) AS order_value,
        CAST(contribution_margin AS DOUBLE) AS contribution_margin,
        CAST(used_discount AS BIGINT) AS used_discount, acquisition_channel, region
        FROM flags WHERE {_VIOLATIONS} = ''""",
    "provenance_report": _provenance(),
    "dataset_fingerprint": """
        SELECT count(*) AS "rows", min(digest) AS least_digest, max(digest) AS greatest_digest,
            CAST(sum(CAST('0x' || substr(digest, 1, 15) AS BIGINT)) AS VARCHAR) AS digest_sum
        FROM digests""",
    "history_split": f"""
        SELECT CASE WHEN order_date < {_DAY} THEN 'history' ELSE 'ignored' END AS side, category,
            count(*) AS orders, min(order_date) AS first_date, max(order_date) AS last_date
        FROM tx GROUP BY 1, 2""",
    "input_summary": f"""
        SELECT count(*) AS input_rows,
            count(*) FILTER (order_date < {_DAY}) AS historical_rows,
            count(*) FILTER (order_date >= {_DAY}) AS ignored_on_or_after_score_date,
            count(DISTINCT customer_id) AS customers,
            (SELECT count(*) FROM d_feat) AS eligible_customers,
            count(DISTINCT category) FILTER (order_date < {_DAY}) AS categories,
            CAST({len(RULES)} AS BIGINT) AS checks_passed
        FROM tx""",
    "sink_roundtrip": " UNION ALL ".join(
        f"""SELECT '{fmt}' AS format, score_date, count(*) AS snapshots,
        CAST(sum(orders_365d) AS BIGINT) AS orders_365d,
        round(CAST(sum(CAST(total_margin_365d AS DECIMAL(18,2))) AS DOUBLE), 6)
            AS total_margin_365d,
        round(max(cadence_progress), 6) AS largest_progress,
        count(DISTINCT last_category) AS last_categories FROM g_feat GROUP BY score_date"""
        for fmt in ("parquet", "csv")
    ),
    "run_metadata": f"""
        SELECT 'supplied_input_scoring' AS mode, '1.0' AS schema_version,
            '{RUN.scoring_date}' AS score_date, (SELECT count(*) FROM digests) AS fingerprint_rows,
            (SELECT CAST(sum(CAST('0x' || substr(digest, 1, 15) AS BIGINT)) AS VARCHAR)
                FROM digests) AS digest_sum,
            (SELECT c_name FROM customer WHERE c_custkey = 1) AS source_name,
            (SELECT count(*) FROM tx WHERE order_date < {_DAY}) AS historical_rows,
            (SELECT count(*) FROM d_feat) AS eligible_customers,
            'smoothed_last_category_baseline' AS category_relevance,
            0.15::DOUBLE AS priority_share, 0.25::DOUBLE AS review_share""",
    "dataset_summary": f"""
        SELECT CAST({RUN.seed} AS BIGINT) AS seed,
            (SELECT count(DISTINCT customer_id) FROM tx) AS customers,
            (SELECT count(*) FROM tx) AS transactions, (SELECT count(*) FROM snap) AS snapshots,
            (SELECT count(next_category) FROM snap WHERE {_TEST}) AS category_test_rows,
            '{RUN.test_start}' AS test_start,
            (SELECT count(*) FROM d_feat) AS scoring_customers""",
    "score_date_grid": "SELECT score_date FROM grid",
    "eligible_customers": _snapshot([]),
    "asof_last_order": _snapshot(
        ["acquisition_channel", "region", "last_category", "last_order_value", "last_order_margin"]
    ),
    "recency_tenure": _snapshot(["recency_days", "customer_tenure_days"]),
    "order_counts": _snapshot(["orders_lifetime", "orders_365d", "orders_90d", "orders_30d"]),
    "order_momentum": _snapshot(["order_momentum"]),
    "monetary_365d": _snapshot(["average_order_value_365d", "total_margin_365d"]),
    "behaviour_shares": _snapshot(["discount_share_365d", "weekend_share_365d"]),
    "category_diversity": _snapshot(["category_diversity_365d"]),
    "favourite_category": _snapshot(["favorite_category", "favorite_category_share_365d"]),
    "gap_stats": _snapshot(["average_gap_days", "gap_variability_days"]),
    "cadence_progress": _snapshot(["cadence_progress"]),
    "lifecycle_segment": _snapshot(["lifecycle_segment"]),
    "calendar_features": _snapshot(["score_month", "score_quarter"]),
    "category_features_long": """
        SELECT customer_id, score_date, category, b.orders AS category_orders_365d,
            round(b.orders / CAST(y.orders_365d AS DOUBLE), 6) AS category_share_365d,
            score_date - b.last_date AS category_recency_days
        FROM g_bycat b JOIN g_year y USING (customer_id, score_date)
        JOIN g_life l USING (customer_id, score_date)""",
    "category_features_wide": _snapshot(_WIDE),
    "forward_labels": _snapshot(_LABELS),
    "labeled_snapshots": _snapshot([*_FEATURES, *_LABELS]),
    "scoring_snapshot": _snapshot(_FEATURES, "d_feat"),
    "temporal_split_counts": f"""
        SELECT CASE WHEN {_TRAIN} THEN 'train' WHEN {_TEST} THEN 'test' ELSE 'validation' END
                AS split,
            count(*) AS snapshots, count(next_category) AS category_labeled,
            CAST(sum(purchase_within_30d) AS BIGINT) AS purchases_within_30d,
            min(score_date) AS first_score_date, max(score_date) AS last_score_date
        FROM snap GROUP BY 1""",
    "leakage_audit": f"""
        SELECT 'scoring_future' AS audit, CAST(0 AS BIGINT) AS vanished_rows,
            CAST(0 AS BIGINT) AS new_rows
        UNION ALL SELECT 'labeled_future', 0, 0
        UNION ALL SELECT 'labeled_past_control', count(*), count(*)
        FROM snap WHERE score_date = DATE '{AUDIT_DATE}'""",
    "leakage_by_date": """
        SELECT score_date, count(DISTINCT customer_id) AS snapshots, max(order_date) AS latest_read,
            min(order_date) FILTER (order_date >= score_date - 365) AS earliest_in_year,
            CAST(0 AS BIGINT) AS state_breaches, CAST(0 AS BIGINT) AS gap_breaches,
            CAST(0 AS BIGINT) AS year_breaches, CAST(0 AS BIGINT) AS label_breaches
        FROM g_hist SEMI JOIN g_life USING (customer_id, score_date) GROUP BY score_date""",
    "aligned_probabilities": f"""
        SELECT customer_id, score_date, 0.0::DOUBLE AS p_absent, 1.0::DOUBLE AS row_total
        FROM snap WHERE {_VALIDATION}""",
    "popularity_baseline": "SELECT category, orders, round(share, 6) AS probability FROM v_pop",
    "popularity_from_history": "SELECT category, orders, round(share, 6) AS probability "
    "FROM h_pop",
    "last_category_baseline": "SELECT customer_id, score_date, last_category, "
    + ", ".join(
        f"round(max(blend) FILTER (category = '{c}'), 6) AS p_{c.lower()}" for c in CLASSES
    )
    + " FROM v_long GROUP BY customer_id, score_date, last_category",
    "cadence_readiness": "SELECT customer_id, score_date, round(readiness, 6) AS readiness "
    "FROM ready",
    "preprocess_numeric": " UNION ALL ".join(
        f"SELECT '{name}' AS feature, round(max(m), 4) AS median, "
        f"round(avg(coalesce(x, m)), 4) AS average, "
        f"round(stddev_samp(coalesce(x, m)), 4) AS deviation "
        f"FROM (SELECT x, median(x) OVER () AS m FROM ("
        f"SELECT CASE WHEN customer_id NOT LIKE '%7' THEN CAST({name} AS DOUBLE) END AS x "
        f"FROM snap WHERE {_TRAIN}))"
        for name in _FEATURES[5:]
    ),
    "preprocess_categorical": f"""
        SELECT region = 'ASIA' AS has_unseen,
            CASE WHEN region = 'ASIA' THEN 4.0::DOUBLE ELSE 5.0::DOUBLE END AS active_slots,
            count(*) AS snapshots FROM snap WHERE {_VALIDATION} GROUP BY 1, 2""",
    "class_weights": f"""
        SELECT purchase_within_30d AS label, count(*) AS "rows",
            round(CAST(sum(count(*)) OVER () AS DOUBLE) / (2 * count(*)), 6) AS weight
        FROM snap WHERE {_TRAIN} GROUP BY 1""",
    "category_comparison_baselines": _both_baselines("v_"),
    "category_test_baselines": _both_baselines("t_"),
    "readiness_comparison_baseline": _BINARY.replace(
        "SELECT ", "SELECT 'cadence_rule_baseline' AS candidate, ", 1
    ),
    "true_class_rank": "SELECT customer_id, score_date, next_category, blend_rank AS true_rank "
    "FROM v_long WHERE category = next_category",
    "top_k_hit_rate": f"SELECT top_1_hit_rate, top_2_hit_rate, top_3_hit_rate FROM ({_RANKING})",
    "mean_reciprocal_rank": f"SELECT mean_reciprocal_rank FROM ({_RANKING})",
    "category_log_loss": f"SELECT log_loss FROM ({_RANKING})",
    "multiclass_brier": f"SELECT multiclass_brier_score FROM ({_RANKING})",
    "category_metrics": _RANKING,
    "per_category_recall": "SELECT category, support, "
    + _rounded("top_1_recall", "top_3_recall")
    + " FROM recall",
    "average_precision": f"SELECT {_rounded('average_precision')} FROM ap",
    "roc_auc": f"SELECT {_rounded('roc_auc')} FROM auc",
    "binary_brier_logloss": f"SELECT {_rounded('brier_score', 'log_loss')} FROM calib",
    "recall_at_top20": f"SELECT {_rounded('recall_at_top_20pct')} FROM topshare",
    "lift_at_top20": f"SELECT {_rounded('lift_at_top_20pct')} FROM topshare",
    "binary_metrics": _BINARY,
    "category_median_margin": "SELECT category, round(expected_category_margin, 6) "
    "AS expected_category_margin FROM margin",
    "top3_categories": "SELECT customer_id, score_date, recommended_category, "
    "round(category_probability, 6) AS category_probability, second_category, third_category "
    "FROM top3",
    "action_score": "SELECT customer_id, score_date, recommended_category, "
    + _rounded(
        "purchase_readiness_30d",
        "category_probability",
        "expected_category_margin",
        "action_score",
    )
    + " FROM action",
    "queue_rank": "SELECT customer_id, round(action_score, 6) AS action_score, queue_rank "
    "FROM queue",
    "capacity_tiers": "SELECT customer_id, queue_rank, capacity_tier FROM queue",
    "activation_queue": f"SELECT {_QUEUE} FROM queue",
    "activation_summary": f"SELECT capacity_tier, recommended_category, {_SUMMARY} FROM queue "
    "GROUP BY capacity_tier, recommended_category",
    "activation_mix": """
        SELECT recommended_category,
            count(*) FILTER (capacity_tier = 'Priority') AS "Priority",
            count(*) FILTER (capacity_tier = 'Review') AS "Review",
            count(*) FILTER (capacity_tier = 'Monitor') AS "Monitor"
        FROM queue GROUP BY recommended_category""",
    "priority_mix": """
        SELECT recommended_category,
            round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1) AS share_percent
        FROM queue WHERE capacity_tier = 'Priority' GROUP BY recommended_category""",
    "queue_top30": f"SELECT {_QUEUE} FROM queue WHERE queue_rank <= 30",
    "score_job": f"SELECT {_QUEUE} FROM queue",
    "sensitive_findings": _scan(["doc_id"]),
    "sensitive_by_label": f"""SELECT label, source, lang, count(*) AS documents
        FROM ({_scan(['source', 'lang'])}) GROUP BY label, source, lang""",
    "transaction_quality": """
        SELECT count(*) AS orders,
            count(*) FILTER (category NOT IN (SELECT category FROM classes))
                AS unknown_categories,
            count(*) FILTER (order_value <= 0) AS non_positive_values,
            count(*) FILTER (contribution_margin < 0) AS negative_margins,
            count(*) FILTER (used_discount = 1) AS discounted_orders,
            count(*) - count(DISTINCT order_id) AS repeated_order_ids,
            count(*) FILTER (used_discount = 1) > 0 AS discount_varies
        FROM tx""",
    "metrics_by_score_month": _ranking_select(
        "v_",
        "blend",
        "blend_rank",
        "SELECT CAST(date_trunc('month', score_date) AS DATE) AS score_month, "
        "count(*) FILTER (category = next_category) AS snapshots,",
    )
    + " GROUP BY 1",
    "readiness_by_month": "SELECT * FROM mmetrics",
    "quality_decline": """
        SELECT task, metric, months, round(first_value, 6) AS first_value,
            round(last_value, 6) AS last_value, round(slope * span, 6) AS change,
            slope * span * sign < 0 AS declines FROM fitted_line""",
    "coverage_gap": """
        SELECT round(max(top_3_recall), 6) AS best_top_3_recall,
            round(min(top_3_recall), 6) AS worst_top_3_recall,
            round(max(top_3_recall) - min(top_3_recall), 6) AS coverage_gap FROM recall""",
    "priority_concentration": """
        SELECT CAST(sum(n) AS BIGINT) AS priority_customers, max(n) AS largest_category_customers,
            round(max(n) / CAST(sum(n) AS DOUBLE), 6) AS largest_category_share
        FROM (SELECT count(*) AS n FROM queue WHERE capacity_tier = 'Priority'
            GROUP BY recommended_category)""",
    "calibration_table": """
        SELECT CAST(least(floor(readiness * 10), 9) AS BIGINT) AS bin, count(*) AS snapshots,
            round(avg(readiness), 6) AS average_score,
            round(avg(CAST(purchase_within_30d AS DOUBLE)), 6) AS observed_rate
        FROM vready GROUP BY 1""",
}


def oracle_sql() -> dict[str, str]:
    return {name: _statement(final) for name, final in FINALS.items()}
