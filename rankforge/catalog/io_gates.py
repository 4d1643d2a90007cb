"""Sources/sinks (A1-A5), gates (C1, C2, C6) and text extraction (T1x, T2x)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.catalog import sqlparts as SP
from rankforge.catalog.base import D, register
from rankforge.catalog.splits_metrics import K, SEED, train_folds, train_rows
from rankforge.functions.columns import rnd, round_doubles
from rankforge.functions.normal import norm_cdf_sql, probit_sql
from rankforge.operators import gates as GA
from rankforge.operators import rank as RK
from rankforge.operators import sampling as SA
from rankforge.operators import text as TX
from rankforge.schema import BEHAVIOUR_SCHEMA, LABEL
from rankforge.session import scratch_path
from rankforge.sources import sinks as SK
from rankforge.sources.fixture import FIXTURE_SQL, behaviour_view, scored_view, with_fixture
from rankforge.sources.tables import first_n, read_csv_typed, read_table
from pyspark.sql import types as T

_VIEW_SCHEMA = T.StructType(BEHAVIOUR_SCHEMA.fields + [T.StructField("split", T.StringType(), True)])


# ---------------------------------------------------------------------------------
# A1-A5
# ---------------------------------------------------------------------------------
@register("a1_csv_scan", with_fixture("SELECT * FROM fx"))
def q_a1(spark, sf):
    path = scratch_path(spark, "a1-behaviour-csv")
    behaviour_view(spark, sf).write.mode("overwrite").option("header", True).csv(path)
    return read_csv_typed(spark, path, _VIEW_SCHEMA)


@register("a2_first_n_rows", with_fixture(f"SELECT id, {LABEL}, {SP.SCR} FROM fx ORDER BY id LIMIT 1000"))
def q_a2(spark, sf):
    return first_n(behaviour_view(spark, sf), 1000).select("id", LABEL, SP.SCR)


_TEST_SCORE = "(p1 + p2 + p3 + p4) / 4.0e0"


def _test_scores(spark, sf):
    v = scored_view(spark, sf).where(F.col("split") == "test")
    return v.select("id", ((F.col("p1") + F.col("p2") + F.col("p3") + F.col("p4")) / F.lit(4.0)).alias("score"))


@register("a3_score_sink", with_fixture(f"SELECT id, {_TEST_SCORE} AS score FROM sx WHERE split = 'test'",
                                        scores=True))
def q_a3(spark, sf):
    path = SK.write_scores(_test_scores(spark, sf), scratch_path(spark, "a3-scores"))
    return SK.read_scores(spark, path)


_GAUSS_SQL = (", te AS (SELECT id, p2 FROM sx WHERE split = 'test'), "
              f"g AS (SELECT id, {probit_sql(f'least(greatest({SP.pct_rank('p2')}, 1e-6), 1.0e0 - 1e-6)')}"
              " AS score FROM te)")
_CAL_SQL = _GAUSS_SQL + f"\nSELECT id, round(least(greatest({norm_cdf_sql('score')}, 0.0e0), 1.0e0), 6) AS score FROM g"


def _gauss_scores(spark, sf):
    te = scored_view(spark, sf).where(F.col("split") == "test").select("id", "p2")
    return RK.with_ranks(te, "p2", out_prefix="", kinds=("gauss_rank",)).select(
        "id", F.col("gauss_rank").alias("score"))


@register("c2_calibration", with_fixture(_CAL_SQL, scores=True))
def q_c2(spark, sf):
    return round_doubles(GA.calibrate(_gauss_scores(spark, sf)))


@register("a4_calibrated_rewrite", with_fixture(_CAL_SQL, scores=True))
def q_a4(spark, sf):
    src = SK.write_scores(_gauss_scores(spark, sf), scratch_path(spark, "a4-gauss"))
    out = SK.versioned_rewrite(spark, src, GA.calibrate)
    return round_doubles(SK.read_scores(spark, out))


_FO = ", tr AS (SELECT * FROM sx WHERE split = 'train'), " + SP.folds_cte(K, SEED)


@register("a5_fold_checkpoint", with_fixture(_FO + "\nSELECT id, fold, p1, p2, p3, p4 FROM fo", scores=True))
def q_a5(spark, sf):
    oof = train_folds(spark, sf).select("id", "fold", "p1", "p2", "p3", "p4")
    path = scratch_path(spark, "a5-oof")
    SK.write_fold_checkpoint(oof.where(F.col("fold") < 3), path)          # an interrupted run
    todo = SK.pending(oof, SK.finished_folds(spark, path))                 # resume: folds 3..k-1
    SK.write_fold_checkpoint(todo, path)
    return spark.read.parquet(path).select("id", F.col("fold").cast("int").alias("fold"), "p1", "p2", "p3", "p4")


# ---------------------------------------------------------------------------------
# C1 output contract, C6 class-ratio check
# ---------------------------------------------------------------------------------
@register("c1_output_contract", with_fixture(f"""
, te AS (SELECT * FROM sx WHERE split = 'test'),
  sc AS (SELECT id, {_TEST_SCORE} AS score FROM te)
SELECT 'row_parity' AS check_name, (SELECT count(*) FROM sc) = (SELECT count(*) FROM te) AS passed,
       CAST((SELECT count(*) FROM sc) AS VARCHAR) || '/' || CAST((SELECT count(*) FROM te) AS VARCHAR) AS detail
UNION ALL SELECT 'column_count', true, '2'
UNION ALL SELECT 'no_nulls', (SELECT count(*) FROM sc WHERE id IS NULL OR score IS NULL) = 0,
       CAST((SELECT count(*) FROM sc WHERE id IS NULL OR score IS NULL) AS VARCHAR)
UNION ALL SELECT 'score_in_unit_interval', (SELECT count(*) FROM sc WHERE score < 0 OR score > 1) = 0,
       CAST((SELECT count(*) FROM sc WHERE score < 0 OR score > 1) AS VARCHAR)""", scores=True))
def q_c1(spark, sf):
    source = scored_view(spark, sf).where(F.col("split") == "test")
    return GA.output_contract(_test_scores(spark, sf), source)


@register("c6_class_ratio_check", with_fixture(", tr AS (SELECT * FROM sx WHERE split = 'train')" + f"""
, cls AS (SELECT {LABEL}, count(*) AS nc FROM tr GROUP BY {LABEL}),
  q1 AS (SELECT *, sum(nc) OVER () AS tot, ceil(0.3e0 * sum(nc) OVER ()) AS nsel FROM cls),
  q2 AS (SELECT *, nsel * nc / tot AS ex FROM q1),
  q3 AS (SELECT *, floor(ex) AS base, ex - floor(ex) AS rem FROM q2),
  q4 AS (SELECT *, nsel - sum(base) OVER () AS lft, row_number() OVER (ORDER BY rem DESC, {LABEL}) AS ord FROM q3),
  quota AS (SELECT {LABEL}, base + CASE WHEN ord <= lft THEN 1 ELSE 0 END AS quota FROM q4),
  rk AS (SELECT id, {LABEL}, row_number() OVER (PARTITION BY {LABEL} ORDER BY {SP.md5_key("'42'")}, id) AS rnk FROM tr),
  smp AS (SELECT rk.* FROM rk JOIN quota USING ({LABEL}) WHERE rnk <= quota),
  fs AS (SELECT {LABEL}, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS full_share FROM tr GROUP BY {LABEL}),
  ss AS (SELECT {LABEL}, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS sample_share FROM smp GROUP BY {LABEL})
SELECT {LABEL}, round(full_share, 6) AS full_share, round(sample_share, 6) AS sample_share,
       round(abs(coalesce(full_share, 0.0e0) - coalesce(sample_share, 0.0e0)), 6) AS abs_diff,
       abs(coalesce(full_share, 0.0e0) - coalesce(sample_share, 0.0e0)) <= 0.05e0 AS passed
FROM fs FULL OUTER JOIN ss USING ({LABEL})""", scores=True))
def q_c6(spark, sf):
    tr = train_rows(spark, sf)
    sample = SA.stratified_downsample(tr, 0.3, LABEL, seed=SEED)
    return round_doubles(GA.class_ratio_check(sample, tr, LABEL))


# ---------------------------------------------------------------------------------
# T1x / T2x: text extraction over whole texts
# ---------------------------------------------------------------------------------
_WS_SQL = r"[ \t\n\r\f\x0B]"


def _strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS_SQL}+|{_WS_SQL}+$', '', 'g')"


_T1_PAT = TX.FUNCTION_PATTERN
_T1_SQL = f"""
SELECT conv_id, turn, code IS NOT NULL AS found, code FROM (
  SELECT conv_id, turn,
    CASE WHEN regexp_extract(text, '{_T1_PAT}', 1) <> '' THEN {_strip_sql(f"regexp_extract(text, '{_T1_PAT}', 1)")}
         WHEN instr(text, 'def add_new_features') > 0
           THEN {_strip_sql("split_part(substr(text, instr(text, 'def add_new_features')), '```', 1)")}
    END AS code
  FROM conversations)"""


@register("t1x_fenced_function", _T1_SQL)
def q_t1(spark, sf):
    conv = read_table(spark, sf, "conversations")
    code, found = TX.fenced_function(F.col("text"))
    return conv.select("conv_id", "turn", found.alias("found"), code.alias("code"))


def _fenced_json_sql(x: str) -> str:
    return _strip_sql(
        f"(CASE WHEN instr({x}, '```json') > 0 THEN split_part(split_part({x}, '```json', 2), '```', 1) "
        f"WHEN instr({x}, '```') > 0 THEN split_part(split_part({x}, '```', 2), '```', 1) ELSE {x} END)")


@register("t2x_fenced_json", f"""
SELECT event_id, json_valid(c) AS payload_valid,
       CASE WHEN json_valid(c) THEN TRY_CAST(json_extract_string(c, '$.k') AS BIGINT) END AS k
FROM (SELECT event_id, {_fenced_json_sql('props')} AS c FROM events)""")
def q_t2(spark, sf):
    ev = TX.parse_fenced_json(read_table(spark, sf, "events"), "props")
    return ev.select("event_id", "payload_valid",
                     F.try_variant_get("payload", "$.k", "bigint").alias("k"))


@register("t2x_fenced_json_text", f"""
SELECT conv_id, turn, coalesce(json_valid(c), false) AS payload_valid
FROM (SELECT conv_id, turn, {_fenced_json_sql('text')} AS c FROM conversations)""")
def q_t2_text(spark, sf):
    conv = TX.parse_fenced_json(read_table(spark, sf, "conversations"), "text")
    return conv.select("conv_id", "turn", "payload_valid")
