"""Write COVERAGE.md: SURVEY §2 operator id -> implementation -> registered queries."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.plans import load_all  # noqa: E402
from ledgerlake.plans.registry import OPERATORS, ORACLE_SQL  # noqa: E402

IMPL = {
    "O-01": "sources.readers.sql_extract (bind params), jdbc_extract", "O-02": "sources.readers.in_list_filter",
    "O-03": "sources.readers.csv_strict (by header name, RFC 4180)", "O-04": "sources.readers.csv_lenient (by header name)",
    "O-05": "sources.readers.read_seed (by header name)",
    "O-06": "plans.tables.Tables, sources.readers.read_table", "O-07": "sources.registry (RunMode, SourceSpec, read_sources)",
    "O-08": "sources.readers.read_table(columns=...)", "O-09": "operators.aggregates.after_watermark",
    "O-10": "operators.aggregates.after_watermark", "O-11": "plans.q_sources.exclusion_extract",
    "O-12": "plans.q_sources.approved_requests_extract, operators.branches.role_lookup", "O-13": "plans.q_sources.rejected_extract",
    "O-14": "operators.branches.union_of_branches (one scan a table)", "O-15": "functions.text.left, plans.q_sources.fallback_extract",
    "O-16": "sources.calendar.date_spine / date_spine_between", "O-17": "operators.merge.append / persist('insert')",
    "O-18": "operators.merge.insert_ignore (order=: first row of a repeated key wins)", "O-19": "operators.merge.upsert, operators.versions.BucketedTable.merge (touched buckets only)", "O-20": "operators.merge.persist",
    "O-21": "operators.merge.resolve_batches (one plan), operators.versions.load_in_batches (commit a batch, ledger, resume)",
    "O-22": "operators.merge.update_only (last_by=: last row of a repeated key wins)", "O-23": "operators.transforms.nan_to_null_columns",
    "O-24": "operators.merge.with_audit_columns, upsert(audit=True)",
    "O-25": "operators.versions.VersionLog, plans.warehouse.materialize, operators.merge.write_snapshot",
    "O-26": "operators.merge.materialize_view", "O-27": "operators.merge.load_once",
    "O-28": "operators.versions.VersionLog.commit, operators.merge.materialize_table", "O-29": "operators.transforms.rename_columns",
    "O-30": "operators.transforms.add_constant", "O-31": "operators.transforms.drop_columns",
    "O-32": "operators.transforms.keep_columns", "O-33": "operators.transforms.drop_null_dates",
    "O-34": "operators.transforms.equality_flag", "O-35": "operators.transforms.inequality_flag",
    "O-36": "operators.transforms.replace_value", "O-37": "F.when chains: plans.silver, plans.gold, q_transforms.family_rule",
    "O-38": "Column.isin / sources.readers.in_list_filter", "O-39": "Column.like / ilike",
    "O-40": "Column.between, operators.joins.validity_window", "O-41": "three-valued Column logic",
    "O-42": "plans.gold.commercial_documents", "O-43": "Column.isNotNull flags",
    "O-44": "F.coalesce, operators.joins.full_override", "O-45": "functions.text.blank_to_null, F.nullif",
    "O-46": "plans.marts (total_factura)", "O-47": "plans.silver.invoices (blank document fallback)",
    "O-48": "DataFrame.join", "O-48b": "operators.branches.role_lookup (one scan for all roles)",
    "O-48c": "plans.gold.fact_staging (left joins)", "O-48d": "operators.joins.full_override",
    "O-48e": "composite-key DataFrame.join", "O-48f": "operators.joins.interval_join / binned_interval_join",
    "O-48g": "operators.joins.effective_join", "O-48h": "operators.joins.validity_window",
    "O-48i": "operators.joins.lookup_default / attach_default_row (scalar subquery)",
    "O-49": "operators.joins.anti_join", "O-50": "operators.joins.exists_in / semi_or (ExistenceJoin)",
    "O-51": "operators.joins.join_back_aggregate", "O-52": "operators.aggregates.high_water_mark(_frame, _by), operators.versions.BucketedTable.mark",
    "O-53": "groupBy + max (plans.gold.inherit_credit_note_group)", "O-54": "operators.aggregates.group_sum",
    "O-55": "DataFrame.distinct", "O-56": "operators.dedup.keep_first (map-side WindowGroupLimit; salted two-phase fallback)",
    "O-57": "plans.silver.first_request_per_invoice", "O-58": "plans.gold.dim_invoices (sale type pick)",
    "O-58b": "plans.marts.sales (representative article)", "O-59": "operators.aggregates.conditional_min_over",
    "O-60": "operators.aggregates.sum_over", "O-61": "operators.transforms.sort_values, operators.keys.global_row_number",
    "O-61b": "operators.dedup.drop_duplicates(row_order=...)", "O-61c": "operators.merge.load_once (EXISTS)",
    "O-61d": "operators.dedup.keep_first", "O-62": "operators.keys.category_codes",
    "O-63": "operators.transforms.cast_datetime_columns, functions.dates.strict_timestamp",
    "O-64": "operators.transforms.cast_float_columns", "O-65": "operators.transforms.cast_integer_columns",
    "O-65b": "operators.transforms.cast_string_columns", "O-65c": "operators.transforms.cast_bool_columns",
    "O-66": "operators.dedup.drop_duplicates", "O-67": "operators.transforms.union_by_name",
    "O-68": "operators.transforms.union_distinct", "O-69": "functions.text.trim_spaces",
    "O-70": "operators.transforms.trim_text_columns, functions.text.strip_whitespace",
    "O-71": "operators.transforms.upper_columns", "O-72": "functions.text.pg_concat / strict_concat",
    "O-73": "F.replace", "O-74": "functions.text.left", "O-75": "functions.text.regex_extract_or_null",
    "O-76": "Column.rlike", "O-77": "F.regexp_replace", "O-78": "functions.text.clean_special, transforms.clean_special_columns",
    "O-79": "functions.text.normalize_text, transforms.normalize_text_columns", "O-80": "decimal arithmetic (plans.gold.fact_staging)",
    "O-81": "functions.numeric.round_half_up", "O-82": "functions.numeric.safe_ratio / ratio_or_null",
    "O-83": "Column.cast, functions.dates.timestamp_text", "O-84": "functions.dates.month_shift",
    "O-85": "sources.calendar.dim_date, functions.dates.is_weekend",
    "O-86": "functions.dates.month_name_padded / day_name_padded", "O-87": "operators.merge (localtimestamp default)",
    "O-88": "Column.isNotNull", "O-89": "operators.keys.dense_keys / stable_keys",
    "O-90": "operators.transforms.chain", "O-91": "every transform is a plain DataFrame -> DataFrame function",
    "O-92": "native Column expressions (no Python UDF)", "O-93": "plans.q_merge.incremental_refresh, streaming.incremental",
    "O-94": "operators.quality.unique_failures", "O-95": "operators.quality.not_null_failures / write_counting_nulls",
    "O-96": "operators.quality.relationship_failures", "O-97": "operators.quality.run_checks / enforce, plans.checks",
    "O-98": "guards: merge.persist, transforms.require_columns / union_by_name",
    "M-01": "plans.silver.requests", "M-02": "plans.silver.articles", "M-03": "plans.silver.customers",
    "M-04": "plans.silver.codes", "M-05": "plans.silver.invoices", "M-06": "plans.silver.lines",
    "M-07": "plans.silver.sellers", "M-08": "plans.gold.dim_articles", "M-09": "plans.gold.dim_customers",
    "M-10": "plans.gold.dim_codes", "M-11": "plans.gold.dim_invoices", "M-12": "plans.gold.dim_sellers",
    "M-13": "sources.calendar.dim_date", "M-14": "plans.gold.fact_staging / inherit_credit_note_group / allocate_cents / fact_billing",
    "M-15": "plans.marts.agreements_customers", "M-16": "plans.marts.agreements_invoices",
    "M-17": "plans.marts.indirect_channel", "M-18": "plans.marts.agreements_fact", "M-19": "plans.marts.sales",
    "M-20": "plans.bronze (LOAD_SPECS, incremental_load, clean_request_source, integrate_requests, load)",
}
# SURVEY §2.14 semantic traps -> decision taken -> where it lives / what checks it
TRAPS = {
    "T-01": ("PG NULL ordering written out", "`asc_nulls_last()` / `desc_nulls_first()` in every window and "
             "sort (operators.dedup, keys, plans.silver/gold); `NULLS LAST/FIRST` in the oracles; every query vs oracle"),
    "T-02": ("total tie-break", "operators.dedup.keep_first appends the natural key; sources in list order; "
             "`test_keep_first_two_phase_equals_one_phase_with_hot_key`, `test_keep_first_equals_window`"),
    "T-03": ("longest-first alternation", "functions.text.regex_extract_or_null; `test_regex_extract_longest_first_and_null`, `regex_extract`"),
    "T-04": ("two concat helpers", "functions.text.pg_concat / strict_concat; `test_pg_concat_skips_null_strict_concat_nulls`, `concat_nulls`"),
    "T-05": ("NOT LIKE / <> / NOT IN drop NULL rows (kept)", "plans.q_sources.fallback_extract, sources.readers.in_list_filter(negate); `fallback_extract`, `rejected_extract`"),
    "T-06": ("blank document shares one group (reproduced)", "plans.silver.invoices (MAX per document before the blank fallback); `invoice_silver`"),
    "T-07": ("fan-out reproduced, caught by unique checks; opt-in fail-early", "plans.silver.invoices, plans.gold.fact_staging, joins.effective_join; plans.checks; `Warehouse(strict=True)` / `joins.expect_unique` (raise_error inside the job); `fact_billing`, `dq_warehouse`, `test_strict_warehouse_fails_on_reproduced_fan_out`"),
    "T-08": ("exact integer-cents allocation", "plans.gold.allocate_cents, functions.numeric.div_round_half_up; `cents_allocation`, `test_cents_residual_bounded`"),
    "T-09": ("zero-sum invoice -> NULL subtotal (parity)", "plans.gold.allocate_cents; `test_allocate_cents_rules`, `cents_allocation`"),
    "T-10": ("un-adjusted lines stay unrounded", "plans.gold.allocate_cents; `test_allocate_cents_rules`"),
    "T-11": ("three-valued commercial rules", "plans.gold.commercial_documents; `three_valued_filter`, `multi_rule_filter`, `test_flags_three_valued`"),
    "T-12": ("NULL conflict key re-inserted (parity)", "operators.merge.upsert routes NULL keys around the join; `test_upsert_null_key_is_inserted_again`, `test_null_keys_bypass_the_merge_join`"),
    "T-13": ("NULL mark loads everything (deliberate)", "operators.aggregates.after_watermark; `test_after_watermark_null_mark_loads_all`, `incremental_refresh`"),
    "T-14": ("watermark column is updated (deliberate)", "plans.bronze.LOAD_SPECS (fecha_hora in the update list); `test_incremental_bronze_invoice_load_equals_full_load`"),
    "T-15": ("extract errors raise (deliberate)", "sources.readers.sql_extract / jdbc_extract / csv_strict; `test_csv_strict_errors`"),
    "T-16": ("binary text order", "Spark and DuckDB both compare binary; values are upper-case ASCII; every query vs oracle"),
    "T-17": ("seed timestamps read as DATE", "plans.seeds (typed seed schemas), plans.standins; `test_read_seed_directory_and_warehouse_override`"),
    "T-18": ("oracle casts `date - INTERVAL` to DATE", "`month_shift` oracle SQL"),
    "T-19": ("stable surrogate keys (deliberate)", "operators.versions.KeyRegistry, operators.keys.stable_keys / dense_keys; `test_stable_keys_keep_existing_ids`, `surrogate_keys`"),
    "T-20": ("`ß` -> `ss` before upper-casing", "functions.text (fixed transliteration table); `normalize_text`, `test_normalize_text_rules`"),
    "T-21": ("clean_special keeps case and deletes controls; normalize_text keeps only spaces", "functions.text.clean_special / normalize_text; `clean_special`, `test_clean_special_transliterates_and_drops_controls`"),
}
PYTEST_ONLY = {"O-90", "O-91", "O-98"}


def main() -> None:
    load_all()
    by_id: dict[str, list[str]] = {}
    for q, ops in OPERATORS.items():
        for tok in ops.split():
            if re.fullmatch(r"[OMT]-\d+[a-z]?(\.\.M-\d+)?", tok):
                by_id.setdefault(tok.split("..")[0], []).append(q)
    lines = ["# COVERAGE — SURVEY §2 inventory → implementation → driver queries", "",
             "Generated by `tools/coverage.py`. Every listed query has a DuckDB oracle in `oracle_sql()`.",
             "IDs marked *pytest* are readers/sinks/guards exercised by `tests/` instead of a query.", "",
             "| id | implementation | queries |", "| --- | --- | --- |"]
    def key(k):
        m = re.match(r"([OM])-(\d+)([a-z]?)", k)
        return (m.group(1), int(m.group(2)), m.group(3))
    for oid in sorted(IMPL, key=key):
        qs = sorted(set(by_id.get(oid, [])))
        cell = ", ".join(f"`{q}`" for q in qs) if qs else ("*pytest*" if oid in PYTEST_ONLY else "—")
        lines.append(f"| {oid} | {IMPL[oid]} | {cell} |")
    lines += ["", "## Semantic traps (SURVEY §2.14)", "", "| id | decision | where / checked by |", "| --- | --- | --- |"]
    lines += [f"| {t} | {d} | {w} |" for t, (d, w) in TRAPS.items()]
    missing = [q for q in OPERATORS if q not in ORACLE_SQL]
    lines += ["", f"Registered queries: {len(OPERATORS)}; with oracle SQL: {len(OPERATORS) - len(missing)}."]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "COVERAGE.md"), "w") as f:
        f.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()
