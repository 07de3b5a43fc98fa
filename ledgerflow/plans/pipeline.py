"""Composed pipelines: every stage is a ``DataFrame -> DataFrame`` operator,
so each pipeline is one lazy plan that Catalyst optimises end to end.

C4 ``posting_plan``      rows -> classified -> costed -> lines -> priced -> routed
C5 ``build_templates``   plan -> allocated -> keyed -> import templates
C6 ``run``               grids -> templates, with stage tables in between
C7 scenario matrix       ``scenario_id=None``: every scenario in one job
C1-C3 ``process_grid``   raw sheet grids -> long rows + cost table
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators import costs, grid, longform
from ledgerflow.operators.allocate import adjust_posting_lines
from ledgerflow.operators.costjoin import enrich_labels, join_ict_costs
from ledgerflow.operators.keys import key_table
from ledgerflow.operators.rules import (CARRY_COLUMNS, DEFAULT_MFF_RATE, DEFAULT_RULESET, OPTIONAL_INPUTS, REQUIRED_COLUMNS,
                                        apply_amount_map, apply_dist_rules,
                                        apply_routing, classify_rows, resolve_dist_rules, resolve_entities,
                                        select_output_cols)
from ledgerflow.operators.templates import build_all_templates
from ledgerflow.sources.stage import by_dealt_key, is_dealt, materialize, materialize_dealt, tasks_for


@dataclass(frozen=True)
class RuleTables:
    dist_rules: DataFrame
    amount_map: DataFrame
    routing_rules: DataFrame


def posting_plan(rows: DataFrame, rules: RuleTables, *, scenario_id: str | None = None,
                 ruleset_id: str = DEFAULT_RULESET, mff_rate: float = DEFAULT_MFF_RATE,
                 cost_table: DataFrame | None = None, with_costs: bool = True,
                 compat: bool = False, strict: bool = True, known: Sequence[str] = ()) -> DataFrame:
    """Long posting plan.  The cost join runs on source rows, before the
    rule join multiplies them into lines (and scenarios).

    ``strict`` (the default) fails on line types without a price, listed twice
    in the amount map or without a route; without it such lines keep NULLs,
    which the audits of ``operators.rules`` report.  ``known``: key columns that
    are never NULL in ``rows``."""
    ctx = classify_rows(rows, ruleset_id=ruleset_id)
    if with_costs:
        ctx = join_ict_costs(ctx, cost_table, compat=compat, known=known)
    lines = apply_dist_rules(ctx, rules.dist_rules, scenario_id=scenario_id, ruleset_id=ruleset_id)
    priced = apply_amount_map(lines, rules.amount_map, mff_rate=mff_rate, strict=strict)
    routed = apply_routing(priced, rules.routing_rules, ruleset_id=ruleset_id, strict=strict)
    return select_output_cols(resolve_entities(routed))


def adjusted_plan(plan: DataFrame, *, method: str = "agg", rows_per_task: int = 2_000_000) -> DataFrame:
    return adjust_posting_lines(plan, method=method, rows_per_task=rows_per_task)


#: Lines of a study that are one task's.
LINES_PER_STUDY = 2_000_000


def most_lines(rules: RuleTables, scenario_id: str | None) -> int:
    """Posting lines that a row gives at most; the rule tables are configuration."""
    scen = [scenario_id] if scenario_id is not None else None
    fan = resolve_dist_rules(rules.dist_rules, scenario_ids=scen, ruleset_id=DEFAULT_RULESET).groupBy("row_category", "medic_key").count()
    listed = rules.amount_map.groupBy("posting_line_type_id").count()
    return max(1, fan.agg(F.max("count")).first()[0] or 1) * max(1, listed.agg(F.max("count")).first()[0] or 1)


def plan_by_study(rows: DataFrame, rules: RuleTables, cost_table: DataFrame, name: str,
                  step: Callable[[DataFrame, Sequence[str]], DataFrame] = lambda plan, known: plan, *,
                  scenario_id: str | None = None, strict: bool = True) -> DataFrame:
    """``step(plan, known)`` of the posting plan (C4).

    Where rows and costs are dealt by study and no study has more lines than one
    task should hold, it is stored in their buckets: neither the cost joins nor
    what ``step`` groups by study deal rows.  Else it is not stored."""
    def made(some: DataFrame, costs: DataFrame, known: Sequence[str] = ()) -> DataFrame:
        return step(posting_plan(some, rules, scenario_id=scenario_id, cost_table=costs, strict=strict, known=known), known)

    out = None
    if is_dealt(rows, "cpms_id"):
        out = by_dealt_key([rows, cost_table], name, "cpms_id", made, LINES_PER_STUDY // most_lines(rules, scenario_id))
    return out if out is not None else made(rows, cost_table).withMetadata("cpms_id", {})


def stored_adjusted_plan(rows: DataFrame, rules: RuleTables, cost_table: DataFrame, *, scenario_id: str | None = None,
                         strict: bool = True, label_source: str | None = None) -> DataFrame:
    """C4 and the allocation, written once for their several consumers.

    Rows and costs that are dealt by study (``stage.materialize_dealt``) stay so
    from here to the templates, unless a study has more lines than one task
    should hold.  ``label_source``: visit labels are taken from the costs first (J14)."""
    def adjusted(some: DataFrame, costs: DataFrame, known: Sequence[str] = ()) -> DataFrame:
        if label_source is not None:
            some = enrich_labels(some, costs, label_source=label_source, known=known)
        plan = posting_plan(some, rules, scenario_id=scenario_id, cost_table=costs, strict=strict, known=known)
        return adjusted_plan(plan, method="window" if known else "agg")

    dealt = None
    if is_dealt(rows, "cpms_id"):
        dealt = by_dealt_key([rows, cost_table], "adjusted_plan", "cpms_id", adjusted, LINES_PER_STUDY // most_lines(rules, scenario_id))
    # Stored as it comes, not in buckets any more.
    return dealt if dealt is not None else materialize(adjusted(rows, cost_table).withMetadata("cpms_id", {}), "adjusted_plan")


def stored_keys(adjusted: DataFrame) -> DataFrame:
    """The key table, which lines and templates of both kinds read; dealt by study as the plan is."""
    keys = by_dealt_key([adjusted], "key_table", "cpms_id", lambda a, known: key_table(a, single=bool(known)), LINES_PER_STUDY)
    return keys if keys is not None else materialize(key_table(adjusted), "key_table")


def by_study(adjusted: DataFrame, others: Sequence[DataFrame], name: str, step: Callable[..., DataFrame]) -> DataFrame:
    """``step`` of a stored plan and other tables, by study where they are dealt so."""
    out = by_dealt_key([adjusted, *others], name, "cpms_id", step, LINES_PER_STUDY)
    return out if out is not None else step(adjusted, *others)


def stored_templates(adjusted: DataFrame) -> DataFrame:
    """All import templates of a stored adjusted plan."""
    return by_study(adjusted, [stored_keys(adjusted)], "templates", lambda a, keys, known=(): build_all_templates(a, keys=keys, known=known))


#: Columns of long rows that a posting plan reads, as far as grids give them.
PLAN_INPUT = tuple(dict.fromkeys([*CARRY_COLUMNS, *REQUIRED_COLUMNS, *OPTIONAL_INPUTS]))


def process_grid(grids: DataFrame, *, strict: bool = True, long_columns: Sequence[str] | None = None,
                 by_study: bool = False) -> tuple[DataFrame, DataFrame]:
    """(long rows with row ids, cost table) of all workbooks, both
    written as stage tables since later stages read them more than once.

    ``long_columns``: only these columns of the long rows, as far as they are
    there.  ``by_study``: both are dealt by study once and stored so."""
    layout, table, clean = grid.stage_a(grids, strict=strict)
    long, cost = longform.stage_b(clean, table, layout), costs.cost_table(table, layout, clean)
    if long_columns is not None:
        long = long.select(*[c for c in long_columns if c in long.columns])
    if not by_study:
        return materialize(long, "grid_long_rows"), materialize(cost, "grid_cost_table")
    tasks = tasks_for(grids.sparkSession, clean.count())
    return tuple(materialize_dealt(df.repartition(tasks, "cpms_id"), name, "cpms_id", tasks)
                 for df, name in ((long, "grid_long_rows"), (cost, "grid_cost_table")))


def build_templates(plan: DataFrame, *, fail_if_empty: bool = False) -> DataFrame:
    """Allocation, keys and all import templates of a posting plan.

    ``fail_if_empty`` raises when the plan gives no template at all (Q7)."""
    return _checked(stored_templates(materialize(adjusted_plan(plan).withMetadata("cpms_id", {}), "adjusted_plan")), fail_if_empty)


def _checked(templates: DataFrame, fail_if_empty: bool) -> DataFrame:
    if fail_if_empty and templates.isEmpty():
        raise ValueError("the posting plan gives no template rows")
    return templates


def run(grids: DataFrame, rules: RuleTables, *, scenario_id: str | None = None, label_source: str = "cost",
        strict: bool = True) -> DataFrame:
    """From raw grids to import templates, every workbook at once.

    ``label_source="cost"`` takes visit labels from the cost table (J14),
    ``"visit"`` keeps the visit as its label."""
    long, cost = process_grid(grids, strict=strict, long_columns=PLAN_INPUT, by_study=True)
    adjusted = stored_adjusted_plan(long, rules, cost, scenario_id=scenario_id, strict=strict, label_source=label_source)
    return _checked(stored_templates(adjusted), strict)
