"""Contracts and findings."""

from pyspark.sql import functions as F

from catalog import metrics as Q
from catalog import segment as C
from catalog import contract_sql as X
from catalog import validation as VQ
from catalog.binding import CTES
from catalog.registry import query
from catalog.segment import KS, SS, US
from catalog.series import K, L, U, delta, grid, tele_raw
from trackgrid.keys import LAP, SESSION
from trackgrid.operators import contracts as T
from trackgrid.operators import quality as R

FOUND = SS + "rule:s count:i fraction:d"


def one(name, *rules, key=("driver", "lap_number"), scope=SESSION):
    return R.Contract(name, tuple(key), tuple(rules), scope=tuple(scope))


def _counted(sql_bad, table, label, extra=""):
    """Findings of one rule as SQL: violating rows per session with their share."""
    return f"""SELECT * FROM (SELECT {KS}, '{label}' AS rule, count(*) FILTER (WHERE {sql_bad}) AS count, count(*) FILTER (WHERE {sql_bad}) / count(*) AS fraction FROM {table} GROUP BY ALL) WHERE count > 0 {extra}"""


@query("qua01_not_null", FOUND, _counted("lap_time IS NULL AND coalesce(is_accurate, false)", "laps", "NotNull unless lap_not_accurate", "AND fraction > 0.02"))
def _(b):
    return R.validate_table(b.laps(), one("laps", R.NotNull(check=("lap_time", "sector1_time"), unless=R.lap_not_accurate, max_fraction=0.02)))


@query("qua02_unique", "l_orderkey:i l_linenumber:i n:i", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _(b):
    marked, bad = R.Unique(key=("l_orderkey", "l_linenumber")).mark(b.table("lineitem"), {}, ())
    return marked.filter(bad).groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))


@query("qua03_foreign_key", "o_custkey:i n:i", "SELECT o_custkey, count(*) AS n FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c_nationkey < 20) GROUP BY ALL")
def _(b):
    rule = R.ForeignKey(key=("o_custkey",), parent="customer", parent_key=("c_custkey",))
    marked, bad = rule.mark(b.table("orders"), {"customer": b.table("customer").filter("c_nationkey < 20")}, ())
    return marked.filter(bad).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


@query("qua03_foreign_key_nullable", FOUND, _counted("k = 7", "(SELECT *, CASE WHEN event_type <> 'view' THEN k END AS kk FROM tele) WHERE kk IS NULL OR true", "ForeignKey -> codes").replace("k = 7", "kk = 7"))
def _(b):
    codes = b.tele().filter("k <> 7").select(*SESSION, "k")
    t = b.tele().withColumn("k", F.when(F.col("event_type") != "view", F.col("k")))
    rule = R.ForeignKey(key=("k",), parent="codes", nullable=True)
    return R.validate_table(t, R.Contract("samples", ("k",), (rule,), ("codes",)), {"codes": codes})


@query("qua04_range", FOUND, _counted("speed < 95 OR speed > 230", "tele", "Range[95.0, 230.0]", "AND fraction > 0.04"))
def _(b):
    return R.validate_table(b.tele(), one("tele", R.Range(column="speed", low=95.0, high=230.0, max_fraction=0.04)))


@query("qua04_range_unless", FOUND, _counted("lap_time > 43.0 AND coalesce(is_accurate, false)", "laps", "Range[20.0, 43.0] unless lap_not_accurate"))
def _(b):
    return R.validate_table(b.laps(), one("laps", R.Range(column="lap_time", low=20.0, high=43.0, unless=R.lap_not_accurate)))


@query("qua05_allowed_values", SS + "count:i detail:s", f"""
SELECT {KS}, count(*) AS count, 'unexpected=["' || string_agg(DISTINCT event_type, '","' ORDER BY event_type) || '"]' AS detail FROM tele WHERE event_type NOT IN ('view', 'click') GROUP BY ALL""")
def _(b):
    return R.validate_table(b.tele(), one("tele", R.AllowedValues(column="event_type", values=("view", "click"))))


@query("qua06_invariant", FOUND, _counted("back", f"(SELECT t.*, EXISTS (SELECT 1 FROM (SELECT *, lag(dn) OVER (PARTITION BY {K} ORDER BY session_time) AS p FROM noisy) n WHERE n.dn - n.p < -1e-6 AND {' AND '.join(f'n.{k} = t.{k}' for k in LAP)}) AS back FROM tele t)", "Invariant(aligned_distance_non_decreasing)"))
def _(b):
    from catalog.series import noisy

    return R.validate_table(noisy(b), one("aligned", R.Invariant(name="aligned_distance_non_decreasing", holds=R.aligned_distance_non_decreasing, about=("distance_aligned",))))


_PRED = f"""
SELECT 'lap_not_accurate' AS predicate, count(*) FILTER (WHERE NOT coalesce(is_accurate, false)) AS n FROM laps
UNION ALL SELECT 'at_grid_zero', count(*) FILTER (WHERE grid_index = 0) FROM grid
UNION ALL SELECT 'before_first_sample', count(*) FILTER (WHERE grid_index < fi) FROM (SELECT *, min(grid_index) FILTER (WHERE source_gap_m IS NOT NULL) OVER (PARTITION BY {K}) AS fi FROM grid)
UNION ALL SELECT 'event_has_no_braking', count(*) FILTER (WHERE NOT has_braking) FROM good_evs
UNION ALL SELECT 'corner_event_has_no_braking', count(*) FILTER (WHERE NOT has_braking) FROM cm JOIN (SELECT {KS}, event_id, has_braking FROM good_evs) USING ({KS}, event_id)
UNION ALL SELECT 'sector_is_not_an_event', count(*) FILTER (WHERE phase IN ('straight', 'bin')) FROM msec
UNION ALL SELECT 'row_is_partial', count(*) FILTER (WHERE partial) FROM mt
UNION ALL SELECT 'sector_has_no_laps', count(*) FILTER (WHERE n_laps = 0) FROM msum
UNION ALL SELECT 'is_the_reference_lap', count(*) FILTER (WHERE is_reference) FROM lsum"""


@query("qua07_permitted_nulls", "predicate:s n:i", _PRED)
def _(b):
    tables = {
        R.lap_not_accurate: b.laps(), R.at_grid_zero: grid(b), R.before_first_sample: grid(b), R.event_has_no_braking: C.events(b),
        R.corner_event_has_no_braking: C.metrics(b), R.sector_is_not_an_event: C.sectors(b), R.row_is_partial: Q.times(b),
        R.sector_has_no_laps: Q.summary(b), R.is_the_reference_lap: Q.lap_summary(b),
    }
    out = None
    for predicate, df in tables.items():
        marked, cond = predicate(df, {"events": C.events(b)}, SESSION)
        row = marked.agg(F.lit(predicate.__name__).alias("predicate"), F.count_if(cond).alias("n"))
        out = row if out is None else out.unionByName(row)
    return out


_INVS = f"""
SELECT 'grid_distance_matches_index' AS invariant, 0 AS n UNION ALL SELECT 'grid_index_contiguous_per_lap', 0
UNION ALL SELECT 'elapsed_time_increasing_per_lap', (SELECT count(*) FROM grid JOIN rising {U} WHERE NOT increasing)
UNION ALL SELECT 'aligned_distance_non_decreasing', 0
UNION ALL SELECT 'aligned_laps_are_accurate', (SELECT count(*) FROM tele t ANTI JOIN (SELECT {K} FROM laps WHERE is_accurate) {U})
UNION ALL SELECT 'microsectors_partition_the_lap', 0 UNION ALL SELECT 'delta_is_zero_at_the_line', 0
UNION ALL SELECT 'event_boundaries_are_ordered', (SELECT count(*) FROM good_evs WHERE NOT (lift_m <= apex_start_m AND apex_start_m < apex_end_m AND apex_end_m <= exit_end_m))
UNION ALL SELECT 'sector_indices_match_distances', 0"""


@query("qua08_invariants", "invariant:s n:i", _INVS)
def _(b):
    tables = {
        R.grid_distance_matches_index: grid(b), R.grid_index_contiguous_per_lap: grid(b), R.elapsed_time_increasing_per_lap: grid(b),
        R.aligned_distance_non_decreasing: tele_raw(b), R.aligned_laps_are_accurate: tele_raw(b), R.microsectors_partition_the_lap: C.sectors(b),
        R.delta_is_zero_at_the_line: delta(b), R.event_boundaries_are_ordered: C.events(b), R.sector_indices_match_distances: C.sectors(b),
    }
    out = None
    for check, df in tables.items():
        marked, cond = check(df, {"laps": b.laps()}, SESSION)
        row = marked.agg(F.lit(check.__name__).alias("invariant"), F.count_if(cond).alias("n"))
        out = row if out is None else out.unionByName(row)
    return out


@query("qua09_validate_table", SS + "rule:s severity:s count:i", f"""
SELECT * FROM (SELECT {KS}, unnest(['NotNull', 'NotNull unless lap_not_accurate', 'ForeignKey -> nowhere [not applicable]']) AS rule, 'error' AS severity, unnest([a, c, n]) AS count FROM
 (SELECT {KS}, count(*) AS n, count(*) FILTER (WHERE compound IS NULL OR is_accurate IS NULL) AS a, count(*) FILTER (WHERE lap_time IS NULL AND coalesce(is_accurate, false)) AS c FROM laps GROUP BY ALL)) WHERE count > 0""")
def _(b):
    base = T.CONTRACTS["laps"]
    return R.validate_table(b.laps(), R.Contract("laps", base.key, (*base.rules, R.ForeignKey(key=("driver",), parent="nowhere"))))


def frames(b):
    aligned = tele_raw(b).withColumn("line_offset_m", F.lit(0.0))
    return {
        "laps": b.staged("laps", b.laps), "car_telemetry": b.car(), "pos_data": b.pos(), "telemetry_aligned": aligned, "grid": grid(b), "events": C.events(b),
        "microsectors": C.sectors(b), "delta_t": delta(b), "microsector_times": Q.times(b), "microsector_summary": Q.summary(b),
        "corner_metrics": C.metrics(b), "lap_summary": Q.lap_summary(b), "ground_truth": VQ.truth(b), "v_min_stability": VQ.stability(b),
    }


def findings(b):
    return b.staged("findings", lambda: R.validate_tables(b.spark, frames(b), {n: c for n, c in T.CONTRACTS.items() if n in T.SESSION_TABLES}, T.OPTIONAL_TABLES))


CTES["found"] = X.findings(X.SESSION_RULES, T.OPTIONAL_TABLES)


@query("qua10_validate_tables", SS + "table:s rule:s severity:s count:i fraction:d", "SELECT * FROM found")
def _(b):
    return findings(b)


@query("qua11_finding_samples", SS + "samples:s", f"""
SELECT {KS}, '[' || string_agg(t, ',' ORDER BY rn) || ']' AS samples FROM (SELECT {KS}, '["' || driver || '","' || lap_number || '"]' AS t, row_number() OVER (PARTITION BY {KS} ORDER BY driver, lap_number) AS rn FROM laps WHERE lap_time > 43.0) WHERE rn <= 20 GROUP BY ALL""")
def _(b):
    return R.validate_table(b.laps(), one("laps", R.Range(column="lap_time", low=20.0, high=43.0)))


_KINDS = "count(*) FILTER (WHERE severity = 'error') AS errors, count(*) FILTER (WHERE severity = 'warning') AS warnings"


@query("qua12_finding_counts", "table:s errors:i warnings:i", f"""SELECT "table", {_KINDS} FROM found GROUP BY ALL""")
def _(b):
    return findings(b).groupBy("table").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))


@query("qua13_contract_version", SS + "rule:s contract_version:s", f"SELECT *, '{R.contract_version(X.SESSION_RULES)}' AS contract_version FROM found")
def _(b):
    return findings(b)


@query("qua14_gate", SS + "open:b", f"""
SELECT {KS}, NOT bool_or(lap_time > 43.0) AS open FROM (SELECT * REPLACE (coalesce(lap_time, 0) AS lap_time) FROM laps) GROUP BY ALL""")
def _(b):
    bad = R.validate_table(b.laps(), one("laps", R.Range(column="lap_time", low=20.0, high=43.0))).filter(F.col("severity") == "error").select(*SESSION).distinct()
    return b.laps().select(*SESSION).distinct().join(bad.withColumn("closed", F.lit(True)), list(SESSION), "left").withColumn("open", F.col("closed").isNull())


@query("qua15_session_contracts", "table:s rows:i broken_rules:i", "SELECT t.*, coalesce(broken_rules, 0) AS broken_rules FROM (" + " UNION ALL ".join(f"""SELECT '{n}' AS "table", count(*) AS rows FROM {t}""" for n, t in X.TABLES.items()) + """) t LEFT JOIN (SELECT "table", count(DISTINCT rule) AS broken_rules FROM found GROUP BY ALL) f USING ("table")""")
def _(b):
    out = None
    for name, df in frames(b).items():
        row = df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"))
        out = row if out is None else out.unionByName(row)
    broken = findings(b).groupBy("table").agg(F.countDistinct("rule").alias("broken_rules"))
    return out.join(broken, "table", "left").fillna(0, ["broken_rules"])


@query("qua16_check_session", "table:s errors:i warnings:i", f"""SELECT "table", {_KINDS} FROM found WHERE rule <> 'Table' GROUP BY ALL""")
def _(b):
    return R.check_session(b.spark, frames(b), {n: T.CONTRACTS[n] for n in frames(b)})["counts"]


_WATCHED = {"car_telemetry": "car", "grid": "grid", "telemetry_aligned": "(SELECT *, 0.0 AS line_offset_m FROM tele_raw)", "lap_summary": "lsum", "ground_truth": "truth", "corner_metrics": "cm"}
_RANGE = lambda table, c: f"""SELECT {KS}, '{table}' AS "table", '{c}' AS "column", min({c}) AS low, max({c}) AS high FROM {_WATCHED[table]} GROUP BY ALL HAVING min({c}) IS NOT NULL"""


@query("agg21_observed_ranges", SS + "table:s column:s low:d high:d", " UNION ALL ".join(_RANGE(t, c) for t, columns in T.REPORTED_RANGES.items() for c in columns))
def _(b):
    return R.observed_ranges(frames(b), T.REPORTED_RANGES)
