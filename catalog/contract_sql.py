"""The contracts' rules as SQL over the bound tables: the same findings, said a second time."""

from __future__ import annotations

from collections.abc import Mapping

from catalog.segment import KS
from catalog.series import K
from trackgrid.keys import LAP, SESSION
from trackgrid.operators import contracts as T
from trackgrid.operators import quality as R

#: Where the bound tables are found in SQL.
TABLES = {
    "laps": "laps", "car_telemetry": "car", "pos_data": "pos", "telemetry_aligned": "(SELECT *, 0.0 AS line_offset_m FROM tele_raw)", "grid": "grid", "events": "good_evs",
    "microsectors": "msec", "delta_t": "(SELECT *, 'session_fastest' AS reference_kind FROM delta)", "microsector_times": "mt", "microsector_summary": "msum",
    "corner_metrics": "cm", "lap_summary": "lsum", "ground_truth": "truth", "v_min_stability": "stab",
}

EXEMPT = {
    "lap_not_accurate": "NOT coalesce(is_accurate, false)",
    "before_first_sample": f"coalesce(grid_index, -1) < coalesce(min(grid_index) FILTER (WHERE source_gap_m IS NOT NULL) OVER (PARTITION BY {K}), 0)",
    "event_has_no_braking": "NOT coalesce(has_braking, false)",
    "corner_event_has_no_braking": "NOT coalesce((SELECT bool_or(e.has_braking) FROM good_evs e WHERE e.season = t.season AND e.round = t.round AND e.session_code = t.session_code AND e.event_id = t.event_id), false)",
    "sector_is_not_an_event": "coalesce(phase IN ('straight', 'bin'), false)",
    "row_is_partial": "coalesce(partial, false)",
    "sector_has_no_laps": "coalesce(n_laps, 0) = 0",
    "is_the_reference_lap": "coalesce(is_reference, false)",
}


def _close(a: str, b: str) -> str:
    return f"coalesce(abs(({a}) - ({b})) <= 1e-3 + 1e-5 * abs({b}), false)"


def _in_group(keys, table: str, columns: str, fault: str) -> str:
    same = " AND ".join(f"n.{k} IS NOT DISTINCT FROM t.{k}" for k in keys)
    return f"EXISTS (SELECT 1 FROM (SELECT *, {columns} FROM {table} q) n WHERE ({fault}) AND {same})"


def invariant(name: str, table: str) -> str:
    lap = f"PARTITION BY {K}"
    return {
        "grid_distance_matches_index": "NOT " + _close("distance_m", "grid_index * 10.0"),
        "grid_index_contiguous_per_lap": f"(min(grid_index) OVER ({lap}) <> 0 OR max(grid_index) OVER ({lap}) + 1 <> count(*) OVER ({lap}) OR count(grid_index) OVER ({lap}) <> count(*) OVER ({lap}) OR count(DISTINCT grid_index) OVER ({lap}) <> count(grid_index) OVER ({lap}))",
        "elapsed_time_increasing_per_lap": _in_group(LAP, table, f"lead(elapsed_time) OVER ({lap} ORDER BY grid_index) AS w, lead(grid_index) OVER ({lap} ORDER BY grid_index) AS i", "i = grid_index + 1 AND NOT w > elapsed_time"),
        "aligned_distance_non_decreasing": _in_group(LAP, table, f"lag(distance_aligned) OVER ({lap} ORDER BY session_time) AS p", "distance_aligned - p < -1e-6"),
        "aligned_laps_are_accurate": f"NOT EXISTS (SELECT 1 FROM laps l WHERE coalesce(l.is_accurate, false) AND {' AND '.join(f'l.{k} = t.{k}' for k in LAP)})",
        "microsectors_partition_the_lap": _in_group((*SESSION, "grain"), table, f"lag(end_m) OVER (PARTITION BY {KS}, grain ORDER BY microsector_id) AS p", f"NOT ({_close('start_m', 'coalesce(p, 0.0)')} AND coalesce(end_m > start_m, false))"),
        "delta_is_zero_at_the_line": "(coalesce(grid_index, -1) = 0 AND coalesce(delta_t_s, 0.0) <> 0)",
        "event_boundaries_are_ordered": "NOT coalesce(lift_m <= apex_start_m AND apex_start_m < apex_end_m AND apex_end_m <= exit_end_m, false)",
        "sector_indices_match_distances": f"NOT ({_close('start_index * 10.0', 'start_m')} AND {_close('end_index * 10.0', 'end_m')})",
    }[name]


def _missing(c: str) -> str:
    return f"({c} IS NULL OR coalesce(isnan(TRY_CAST({c} AS DOUBLE)), false))"


def violates(rule: R.Rule, table: str) -> str:
    """The condition of a violating row of ``table t``."""
    bad = ""
    if isinstance(rule, R.NotNull):
        bad = "(" + " OR ".join(_missing(c) for c in rule.check) + ")"
    elif isinstance(rule, R.Unique):
        bad = f"count(*) OVER (PARTITION BY {', '.join(dict.fromkeys((*SESSION, *rule.key)))}) > 1"
    elif isinstance(rule, R.ForeignKey):
        same = " AND ".join([f"p.{c} = t.{c}" for c in SESSION] + [f"p.{b} = t.{a}" for a, b in zip(rule.key, rule.parent_key or rule.key, strict=True)])
        orphan, null = f"NOT EXISTS (SELECT 1 FROM {TABLES[rule.parent]} p WHERE {same})", " OR ".join(_missing(f"t.{c}") for c in rule.key)
        bad = f"({orphan} AND NOT ({null}))" if rule.nullable else f"({orphan} OR {null})"
    elif isinstance(rule, R.Range):
        v = f"TRY_CAST({rule.column} AS DOUBLE)"
        bad = f"(coalesce({v} < {rule.low} OR {v} > {rule.high}, false) AND NOT coalesce(isnan({v}), false))"
    elif isinstance(rule, R.AllowedValues):
        bad = f"({rule.column} IS NOT NULL AND {rule.column} NOT IN ({', '.join(repr(v) for v in rule.values)}))"
    elif isinstance(rule, R.Invariant):
        return invariant(rule.name, table)
    unless = getattr(rule, "unless", None)
    return f"({bad} AND NOT {EXEMPT[unless.__name__]})" if unless else bad


def table_findings(name: str, contract: R.Contract) -> str:
    table = TABLES[name]
    marks = ", ".join(f"({violates(rule, table)}) AS b{i}" for i, rule in enumerate(contract.rules))
    counts = ", ".join(f"count(*) FILTER (WHERE b{i}) AS c{i}" for i in range(len(contract.rules)))
    rows = " UNION ALL ".join(
        f"SELECT {KS}, '{name}' AS \"table\", '{rule.label}' AS rule, '{rule.severity}' AS severity, c{i} AS count, c{i} / n AS fraction FROM counted WHERE c{i} > 0 AND c{i} / n > {rule.max_fraction}"
        for i, rule in enumerate(contract.rules)
    )
    return f"SELECT * FROM (WITH counted AS (SELECT {KS}, count(*) AS n, {counts} FROM (SELECT {KS}, {marks} FROM {table} t) GROUP BY ALL) {rows})"


def findings(contracts: Mapping[str, R.Contract], optional: frozenset[str] = frozenset()) -> str:
    """Findings of every contract whose table is bound; a table that is not is a warning."""
    bound = [table_findings(name, c) for name, c in contracts.items() if name in TABLES]
    absent = [f"SELECT NULL, NULL, NULL, '{name}', 'Table', 'warning', 0, 1.0" for name in contracts if name not in TABLES and name not in optional]
    return " UNION ALL ".join(bound + absent)


SESSION_RULES = {n: c for n, c in T.CONTRACTS.items() if n in T.SESSION_TABLES}
