"""The behaviour view over the driver's ``orders`` table (FIXTURES.md part 2).

The driver tables hold no behaviour data, so every operator is exercised on a
deterministic projection of ``orders`` (``o_orderkey`` is unique).  Only
``+ - * / % floor`` are used, so Spark and DuckDB produce identical doubles.
The same view is written once more in SQL (``FIXTURE_SQL``) for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.sources.tables import read_table


def _d(x: float) -> Column:
    return F.lit(float(x))


def _null_if(cond: Column, value: Column) -> Column:
    return F.when(~cond, value)


def behaviour_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, 12 behaviour columns, addicted_label, split) — one row per order."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    ok, ck, tp = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    pri = F.substring(F.col("o_orderpriority"), 1, 1)
    screen = F.floor(tp / _d(3571)) / _d(10)
    high = pri.isin("1", "2")
    return o.select(
        ok.alias("id"),
        _null_if(ck % 23 == 0, (F.lit(10) + ck % 70).cast("double")).alias("age"),
        _null_if(ok % 29 == 0, F.when(ck % 2 == 0, F.lit("Male")).otherwise(F.lit("Female"))).alias("gender"),
        _null_if(ok % 11 == 0, screen).alias("daily_screen_time_hours"),
        _null_if(ok % 13 == 0, (ck % 41) / _d(10)).alias("social_media_hours"),
        _null_if(ok % 17 == 0, (ok % 31) / _d(10)).alias("gaming_hours"),
        _null_if(ok % 19 == 0, ((ok + ck) % 61) / _d(10)).alias("work_study_hours"),
        _null_if(ck % 37 == 0, _d(4) + (ok % 51) / _d(10)).alias("sleep_hours"),
        _null_if(ok % 7 == 0, ((ok * 7 + ck) % 200).cast("double")).alias("notifications_per_day"),
        _null_if(ck % 31 == 0, (F.lit(5) + (ok * 3 + ck * 5) % 175).cast("double")).alias("app_opens_per_day"),
        _null_if(ok % 25 == 0, screen + (ck % 20) / _d(10)).alias("weekend_screen_time"),
        F.when(high, F.lit("High")).when(pri == "3", F.lit("Medium"))
         .when(pri == "4", F.lit("Low")).alias("stress_level"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Yes"))
         .when(F.col("o_orderstatus") == "O", F.lit("No")).alias("academic_work_impact"),
        F.when(tp / _d(35714) + (ck % 41) / _d(10)
               + F.when(high, _d(1.5)).otherwise(_d(0)) + (ok % 7) / _d(2) > _d(11), F.lit(1))
         .otherwise(F.lit(0)).alias("addicted_label"),
        F.when(ok % 5 == 4, F.lit("test")).otherwise(F.lit("train")).alias("split"),
    )


def fixture_scores(df: DataFrame) -> DataFrame:
    """Adds model-free scores p1..p4 (ties on purpose) to the behaviour view."""
    cs = F.coalesce(F.col("daily_screen_time_hours"), _d(5))
    so = F.coalesce(F.col("social_media_hours"), _d(2))
    ap = F.coalesce(F.col("app_opens_per_day"), _d(90))
    sl = F.coalesce(F.col("sleep_hours"), _d(6))
    return df.withColumns({
        "p1": cs / (cs + _d(6)),
        "p2": (cs + so) / (cs + so + _d(9)),
        "p3": (cs + ap / _d(100)) / (cs + ap / _d(100) + _d(7)),
        "p4": so / (so + sl),
    })


def scored_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_scores(behaviour_view(spark, sf_dir))


# ---- the same view in DuckDB SQL (oracle side) ---------------------------------
FIXTURE_SQL = """
SELECT o_orderkey AS id,
  CASE WHEN o_custkey % 23 = 0 THEN NULL ELSE CAST(10 + o_custkey % 70 AS DOUBLE) END AS age,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE floor(o_totalprice / CAST(3571 AS DOUBLE)) / CAST(10 AS DOUBLE) END AS daily_screen_time_hours,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE (o_custkey % 41) / CAST(10 AS DOUBLE) END AS social_media_hours,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE (o_orderkey % 31) / CAST(10 AS DOUBLE) END AS gaming_hours,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE ((o_orderkey + o_custkey) % 61) / CAST(10 AS DOUBLE) END AS work_study_hours,
  CASE WHEN o_custkey % 37 = 0 THEN NULL ELSE CAST(4 AS DOUBLE) + (o_orderkey % 51) / CAST(10 AS DOUBLE) END AS sleep_hours,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST((o_orderkey * 7 + o_custkey) % 200 AS DOUBLE) END AS notifications_per_day,
  CASE WHEN o_custkey % 31 = 0 THEN NULL ELSE CAST(5 + (o_orderkey * 3 + o_custkey * 5) % 175 AS DOUBLE) END AS app_opens_per_day,
  CASE WHEN o_orderkey % 25 = 0 THEN NULL ELSE floor(o_totalprice / CAST(3571 AS DOUBLE)) / CAST(10 AS DOUBLE) + (o_custkey % 20) / CAST(10 AS DOUBLE) END AS weekend_screen_time,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'High' WHEN '2' THEN 'High' WHEN '3' THEN 'Medium' WHEN '4' THEN 'Low' ELSE NULL END AS stress_level,
  CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'O' THEN 'No' ELSE NULL END AS academic_work_impact,
  CASE WHEN o_totalprice / CAST(35714 AS DOUBLE) + (o_custkey % 41) / CAST(10 AS DOUBLE)
            + (CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN CAST(1.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)
            + (o_orderkey % 7) / CAST(2 AS DOUBLE) > CAST(11 AS DOUBLE) THEN 1 ELSE 0 END AS addicted_label,
  CASE WHEN o_orderkey % 5 = 4 THEN 'test' ELSE 'train' END AS split
FROM orders
"""

SCORES_SQL = """
SELECT *,
  cs / (cs + CAST(6 AS DOUBLE)) AS p1,
  (cs + so) / (cs + so + CAST(9 AS DOUBLE)) AS p2,
  (cs + ap / CAST(100 AS DOUBLE)) / (cs + ap / CAST(100 AS DOUBLE) + CAST(7 AS DOUBLE)) AS p3,
  so / (so + sl) AS p4
FROM (SELECT *,
  coalesce(daily_screen_time_hours, CAST(5 AS DOUBLE)) AS cs,
  coalesce(social_media_hours, CAST(2 AS DOUBLE)) AS so,
  coalesce(app_opens_per_day, CAST(90 AS DOUBLE)) AS ap,
  coalesce(sleep_hours, CAST(6 AS DOUBLE)) AS sl
  FROM fx)
"""


def with_fixture(sql_body: str, scores: bool = False) -> str:
    """Prefix an oracle query with the fixture CTEs ``fx`` (and ``sx``)."""
    ctes = f"fx AS ({FIXTURE_SQL})"
    if scores:
        ctes += (f", sx AS (SELECT * EXCLUDE (cs, so, ap, sl) FROM ({SCORES_SQL}))")
    return f"WITH {ctes}\n{sql_body}"
