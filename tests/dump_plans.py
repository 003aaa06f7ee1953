"""Write docs/plans.md: the physical plan trees of key queries (AQE off, so the
static plan is shown).  Usage: python tests/dump_plans.py [sf_dir]"""

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

NOTES = {
    "forecast_points": "Flagship. Pruned scan -> partial aggregate -> exchange on (id, ds) -> final aggregate -> "
                       "one small exchange on unique_id -> windows and the statistics aggregate with no further exchange.",
    "forecast_long_builtin": "Context cut as a window group limit: Partial limit before the exchange on unique_id, Final after.",
    "context_window": "Cut rows x relative positions joined to positioned points on (unique_id, pos): an equi-join.",
    "rolling_eval_windows": "Specs travel as a literal array (Generate), no join with the spec table.",
    "global_shuffle": "Range partitioning; the only single-partition exchange sits above the per-partition counts.",
    "mixture_sample": "Salted equi-join on (dataset, _idx, _salt); per-dataset metadata broadcast.",
    "registry_score": "Version and parameters enter as scalar subqueries; no join with the registry.",
    "latest_version": "Names unioned with the registry and aggregated once; no join.",
    "score_requests": "One from_json per request shape; generators are outer so no inferred filter re-runs the parse.",
    "select_series": "The id predicate reaches the Parquet scan (PushedFilters).",
}


def main():
    from tidecast.session import local_session
    import __spark_entry__ as E
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    out = ["# Physical plans of key queries", "",
           f"Generated by `tests/dump_plans.py` at `{os.path.basename(sf)}` with AQE off (static plans; at run time AQE",
           "may coalesce partitions or switch join strategies).  Operator trees only; `explain('formatted')` gives details.", ""]
    for name, note in NOTES.items():
        df = E.queries()[name](spark, sf)
        tree = df._jdf.queryExecution().executedPlan().treeString()
        lines = [ln[:160] for ln in tree.splitlines()]
        out += [f"## `{name}`", "", note, "", "```", *lines, "```", ""]
    with open(os.path.join(ROOT, "docs", "plans.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
