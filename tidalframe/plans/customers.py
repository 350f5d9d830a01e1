"""Customer value."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.operators import customers, gammagamma, splits
from tidalframe.plans.inputs import LOG, transactions
from tidalframe.plans.registry import query
from tidalframe.session import cut_lineage

RFM = f"""{LOG}, cut AS (SELECT max(date) - 90 AS cut FROM log),
before AS (SELECT * FROM log WHERE date <= (SELECT cut FROM cut)), after AS (SELECT * FROM log WHERE date > (SELECT cut FROM cut)),
features AS (SELECT customer_id, CAST(max(date) - (SELECT max(date) FROM before) AS INT) AS recency, count(*) AS frequency,
  CAST(SUM(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS price_sum,
  CAST(SUM(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / count(price) AS price_mean FROM before GROUP BY 1),
targets AS (SELECT customer_id, CAST(SUM(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS spend_90_total, 1 AS spend_90_flag FROM after GROUP BY 1),
rfm AS (SELECT f.*, coalesce(spend_90_total, 0.0) AS spend_90_total, coalesce(spend_90_flag, 0) AS spend_90_flag
  FROM features f LEFT JOIN targets USING (customer_id))"""


def rfm_table(spark: SparkSession, root: str) -> DataFrame:
    """Features up to 90 days before the end and the spend of those 90 days."""
    split = splits.time_split(transactions(spark, root), "date", "90 days")
    return customers.features_with_targets(
        splits.training(split), splits.testing(split), "customer_id", "date", "price"
    )


@query("rfm_features", f"WITH {RFM} SELECT * FROM rfm")
def rfm_features(spark: SparkSession, root: str) -> DataFrame:
    return rfm_table(spark, root)


@query(
    "rfm_cohort",
    f"""WITH {LOG}, ids AS (SELECT customer_id FROM log GROUP BY 1 HAVING min(date) BETWEEN DATE '1995-01-01' AND DATE '1995-03-31')
SELECT CAST(date_trunc('month', date) AS DATE) AS date, CAST(SUM(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
  count(DISTINCT customer_id) AS n_customers FROM log WHERE customer_id IN (SELECT customer_id FROM ids) GROUP BY 1""",
)
def rfm_cohort(spark: SparkSession, root: str) -> DataFrame:
    """Monthly revenue of customers who first bought in the first quarter."""
    log = transactions(spark, root)
    rows = customers.cohort(log, "customer_id", "date", dt.date(1995, 1, 1), dt.date(1995, 3, 31))
    return rows.groupBy(F.trunc("date", "month").alias("date")).agg(
        F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("total_price"),
        F.countDistinct("customer_id").alias("n_customers"),
    )


SPLIT = dt.date(2000, 1, 1)
CBS = f"""{LOG}, days AS (SELECT customer_id, date, SUM(CAST(price AS DECIMAL(18,2))) AS spend FROM log WHERE date <= DATE '{SPLIT}' GROUP BY 1, 2),
cbs AS (SELECT customer_id, count(*) - 1 AS x, CAST(max(date) - min(date) AS INT) AS t_x, CAST(DATE '{SPLIT}' - min(date) AS INT) AS age,
  count(*) AS n_days, CAST(SUM(spend) AS DOUBLE) / count(*) AS mean_spend FROM days GROUP BY 1)"""


def summary(spark: SparkSession, root: str) -> DataFrame:
    return customers.transaction_summary(transactions(spark, root), "customer_id", "date", "price", SPLIT)


@query("clv_cbs", f"WITH {CBS} SELECT * FROM cbs")
def clv_cbs(spark: SparkSession, root: str) -> DataFrame:
    return summary(spark, root)


P, Q, GAMMA = 6.25, 3.74, 1544.0


@query(
    "clv_gamma_gamma",
    f"WITH {CBS} SELECT customer_id, round({P} * ({GAMMA} + n_days * mean_spend) / ({P} * n_days + {Q} - 1.0), 4) AS expected_spend FROM cbs",
)
def clv_gamma_gamma(spark: SparkSession, root: str) -> DataFrame:
    """Expected mean spend per customer for given parameters."""
    value = customers.expected_spend(F.col("n_days"), F.col("mean_spend"), P, Q, GAMMA)
    return summary(spark, root).select("customer_id", F.round(value, 4).alias("expected_spend"))


@query("clv_gamma_gamma_fit")
def clv_gamma_gamma_fit(spark: SparkSession, root: str) -> DataFrame:
    """Parameters found by maximum likelihood, then expected spend per customer."""
    rows = cut_lineage(summary(spark, root))
    p, q, gamma, _ = gammagamma.fit(rows, "n_days", "mean_spend")
    value = customers.expected_spend(F.col("n_days"), F.col("mean_spend"), p, q, gamma)
    return rows.select("customer_id", "n_days", "mean_spend", value.alias("expected_spend"))


SCORED = f"""{RFM}, scored AS (SELECT *, round(1 / (1 + exp(-(0.25 * frequency - 3 + recency / 400.0))), 6) AS pred_prob,
  round(price_sum / 20 + recency * 10, 6) AS pred_total FROM rfm)"""


@query(
    "rfm_questions",
    f"""WITH {SCORED}
SELECT 'likely to spend' AS question, customer_id, pred_prob, pred_total FROM scored
UNION ALL SELECT 'recent but unlikely', customer_id, pred_prob, pred_total FROM scored WHERE recency > -90 AND pred_prob < 0.2
UNION ALL SELECT 'missed', customer_id, pred_prob, pred_total FROM scored WHERE spend_90_total = 0""",
)
def rfm_questions(spark: SparkSession, root: str) -> DataFrame:
    """Who will probably spend (every customer, by probability); who bought lately but will not; who was expected to and did not."""
    odds = 0.25 * F.col("frequency") - 3 + F.col("recency") / 400.0
    scored = rfm_table(spark, root).withColumns(
        {
            "pred_prob": F.round(1 / (1 + F.exp(-odds)), 6),
            "pred_total": F.round(F.col("price_sum") / 20 + F.col("recency") * 10, 6),
        }
    )

    def answer(question: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(question).alias("question"), "customer_id", "pred_prob", "pred_total")

    unlikely = scored.where("recency > -90 AND pred_prob < 0.2")
    missed = scored.where("spend_90_total = 0")
    return (
        answer("likely to spend", scored)
        .unionByName(answer("recent but unlikely", unlikely))
        .unionByName(answer("missed", missed))
    )
