"""Row projections: vault formulas (G1-G4, G6-G13, G16-G19), validation and schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.catalog import sqlparts as SP
from rankforge.catalog.base import D, register
from rankforge.functions.columns import round_doubles
from rankforge.operators import features as FE
from rankforge.operators import validate as VA
from rankforge.schema import LABEL, NUMERIC_COLUMNS
from rankforge.sources.fixture import behaviour_view, with_fixture
from rankforge.sources.tables import read_table

SCR, SOC, GAM, WRK, SLP, NTF, APP, WKD = (SP.SCR, SP.SOC, SP.GAM, SP.WRK, SP.SLP, SP.NTF, SP.APP, SP.WKD)


def _nn(x: str, expr: str) -> str:
    """NULL-propagating wrapper for least/greatest (both engines skip NULL args)."""
    return f"(CASE WHEN ({x}) IS NULL THEN NULL ELSE {expr} END)"


_AWAKE = _nn(f"{D(24)} - {SLP}", f"least(greatest({D(24)} - {SLP}, {D(4)}), {D(20)})")
_ACT = f"({SOC} + {GAM} + {WRK})"
_SH = [f"({x} / NULLIF({_ACT}, 0))" for x in (SOC, GAM, WRK)]
_ORD = "(CASE stress_level WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 END)"

VAULT_SQL = {
    "compulsive_checking_velocity": f"({NTF} / ({APP} + {D(1)})) * ({SCR} / NULLIF({D(24)} - {SLP}, 0))",
    "circadian_dopamine_strain": f"{_nn(f'{D(8)} - {SLP}', f'greatest({D(8)} - {SLP}, {D(0)})')}"
                                 f" * pow({SOC} + {GAM}, {D(1.5)}) / ({SLP} + {D(1)})",
    "synthetic_budget_deficit": f"({SOC} + {GAM} + {WRK}) - {SCR}",
    "synthetic_budget_violation": f"CAST(({SOC} + {GAM} + {WRK}) > {SCR} AS INTEGER)",
    "B_ISAT": f"({APP} / ({SCR} + 1e-6)) / ({NTF} + 1e-6)",
    "H_AF": f"-({_SH[0]} * ln({_SH[0]} + 1e-6) + {_SH[1]} * ln({_SH[1]} + 1e-6) + {_SH[2]} * ln({_SH[2]} + 1e-6))",
    "CDUR": f"(({SOC} + {GAM}) / ({WRK} + 1e-6)) * ({D(24)} / ({SLP} + 1e-6))",
    "dopamine_chasing_index": f"ln({D(1)} + {APP} / ({NTF} + {D(1)})) * ({D(1)} / ({D(1)} + exp(-({SOC} + {GAM} - {D(3)}))))",
    "compulsive_checking_density": f"(({APP} + {NTF}) / NULLIF({D(24)} - {SLP}, 0)) * ({D(1)} / ({SCR} + 1e-6))",
    "sigmoid_inflection_6h": f"{D(1)} / ({D(1)} + exp({D(-3)} * ({SCR} - {D(6.25)})))",
    "sigmoid_inflection_8h": f"{D(1)} / ({D(1)} + exp({D(-4)} * ({SCR} - {D(8)})))",
    "screen_extreme_flag": f"CAST({SCR} >= {D(9.5)} AS INTEGER)",
    "screen_safe_flag": f"CAST({SCR} <= {D(3.5)} AS INTEGER)",
    "awake_hours": _AWAKE,
    "leisure_to_awake_ratio": f"({SOC} + {GAM}) / {_AWAKE}",
    "screen_to_awake_ratio": f"{SCR} / {_AWAKE}",
    "nocturnal_displacement_risk": _nn(f"({SCR} + {WRK}) - {_AWAKE}", f"greatest(({SCR} + {WRK}) - {_AWAKE}, {D(0)})"),
    "screen_x_social": f"{SCR} * {SOC}",
    "screen_per_awake_budget": f"{SCR} / NULLIF({D(24)} - {SLP}, 0)",
    "WESI": f"(({WKD} - {SCR}) / ({SCR} + {SP.EPS})) * {_ORD}",
    "sleep_displacement": f"{D(24)} - {SLP} - {WRK}",
    "strict_social_to_screen": f"CASE WHEN {SCR} > 0 THEN {SOC} / {SCR} END",
}


def _round_sql(name, expr):
    is_int = expr.startswith("CAST(") and expr.endswith("AS INTEGER)")
    return f"{expr} AS {name}" if is_int else f"round({expr}, 6) AS {name}"


@register("g01_g19_vault_features", with_fixture(
    "SELECT id, " + ", ".join(_round_sql(k, v) for k, v in VAULT_SQL.items()) + " FROM fx"))
def q_vault(spark, sf):
    df = behaviour_view(spark, sf)
    return round_doubles(df.select("id", *[v.alias(k) for k, v in FE.vault_features(df).items()]))


_LAT_COLS = [SCR, SOC, GAM, WRK, SLP]


@register("g11_decimal_lattice", with_fixture("SELECT id, " + ", ".join(
    f"round({c} - floor({c}), 6) AS {c}_frac, CAST(floor({c} * {D(10)}) % 10 AS INTEGER) AS {c}_d1, "
    f"round(abs({c} - round_even({c}, 0)), 6) AS {c}_dist_int, "
    f"CAST(abs(({c} - floor({c})) - {D(0.5)}) < 1e-4 AS INTEGER) AS {c}_is_exact_half" for c in _LAT_COLS)
    + " FROM fx"))
def q_g11(spark, sf):
    df = behaviour_view(spark, sf)
    return round_doubles(df.select("id", *[v.alias(k) for k, v in FE.decimal_lattice(df, _LAT_COLS).items()]))


@register("g18_missingness_vector", with_fixture("SELECT id, " + ", ".join(
    f"CAST({c} IS NULL AS INTEGER) AS {c}_is_null" for c in NUMERIC_COLUMNS)
    + ", CAST((" + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in NUMERIC_COLUMNS) + ") > 0 AS INTEGER) AS any_null"
    + ", CAST(" + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in NUMERIC_COLUMNS) + " AS INTEGER) AS row_null_count"
    + " FROM fx"))
def q_g18(spark, sf):
    df = behaviour_view(spark, sf)
    return df.select("id", *[v.alias(k) for k, v in FE.missingness(df).items()])


# ---------------------------------------------------------------------------------
# B1-B5, B9
# ---------------------------------------------------------------------------------
@register("b1_drop_columns", with_fixture(f"SELECT * EXCLUDE (id, {LABEL}, split) FROM fx"))
def q_b1(spark, sf):
    return VA.drop_columns(behaviour_view(spark, sf), ["id", LABEL, "split", "not_a_column"])


@register("b2_numeric_coercion", """
SELECT o_orderkey AS id, TRY_CAST(o_orderpriority AS DOUBLE) AS priority_num,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority_digit,
       TRY_CAST(o_orderstatus AS DOUBLE) AS status_num, CAST(NULL AS DOUBLE) AS absent_col
FROM orders""")
def q_b2(spark, sf):
    o = read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority_num"),
        F.substring("o_orderpriority", 1, 1).alias("priority_digit"), F.col("o_orderstatus").alias("status_num"))
    return VA.coerce_numeric(o, ["priority_num", "priority_digit", "status_num", "absent_col"])


@register("b3_zero_fill", with_fixture(
    f"SELECT id, coalesce({SOC}, 0.0e0) + coalesce({GAM}, 0.0e0) AS leisure_filled FROM fx"))
def q_b3(spark, sf):
    df = behaviour_view(spark, sf)
    return df.select("id", (VA.zero_fill(SOC) + VA.zero_fill(GAM)).alias("leisure_filled"))


_NARROW = {"age": (10.0, 60.0), SCR: (0.0, 12.0), SLP: (0.0, 24.0)}


@register("b4_row_validation", with_fixture(f"""
SELECT id, CAST(len(v) AS INTEGER) AS n_violations, array_to_string(v, '; ') AS violations FROM (
  SELECT id, list_filter([CASE WHEN age < {D(10)} OR age > {D(60)} THEN 'age out of [10.0, 60.0]' END,
                          CASE WHEN {SCR} < {D(0)} OR {SCR} > {D(12)} THEN '{SCR} out of [0.0, 12.0]' END,
                          CASE WHEN {SLP} < {D(0)} OR {SLP} > {D(24)} THEN '{SLP} out of [0.0, 24.0]' END],
                         lambda x: x IS NOT NULL) AS v FROM fx)
WHERE len(v) > 0"""))
def q_b4(spark, sf):
    _, rejected = VA.validate_rows(behaviour_view(spark, sf), _NARROW)
    return rejected.select("id", F.size("violations").alias("n_violations"),
                           F.array_join("violations", "; ").alias("violations"))


@register("b4_valid_rows", with_fixture(f"""
SELECT count(*) AS n_valid FROM fx
WHERE NOT coalesce(age < {D(10)} OR age > {D(60)}, false)
  AND NOT coalesce({SCR} < {D(0)} OR {SCR} > {D(12)}, false)
  AND NOT coalesce({SLP} < {D(0)} OR {SLP} > {D(24)}, false)"""))
def q_b4_valid(spark, sf):
    valid, _ = VA.validate_rows(behaviour_view(spark, sf), _NARROW)
    return valid.agg(F.count(F.lit(1)).alias("n_valid"))


@register("b5_downcast", with_fixture(f"""
SELECT CAST({LABEL} AS TINYINT) AS {LABEL}, CAST({SCR} AS FLOAT) AS {SCR}, CAST(age AS FLOAT) AS age FROM fx"""))
def q_b5(spark, sf):
    return VA.downcast(behaviour_view(spark, sf).select(LABEL, SCR, "age"))


@register("b9_predicate_filter", with_fixture(f"""
SELECT id FROM fx WHERE {SCR} > {D(6)} AND {WRK} > {D(5)}"""))
def q_b9(spark, sf):
    df = behaviour_view(spark, sf)
    return df.where((F.col(SCR) > 6.0) & (F.col(WRK) > 5.0)).select("id")
