"""End-to-end jobs for the three entry points of the source system.

Each job is one Spark application step: read -> plan -> write a new version.
Outputs are written under a root folder on shared storage; every run writes
new directories (``run=<id>``), so a retried run never overwrites what a
reader is using, and re-running a run id rewrites the same content.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import fingerprint as FP
from ..operators import joins as J
from ..operators.changes import field_diff
from ..operators.merge import merge_snapshot
from ..operators.payloads import update_payload
from ..session import cut_lineage
from ..schemas import LEAD_DIFF_COLS
from ..sources.standins import DomainTables
from . import views as V


def outbound_updates(t: DomainTables, ledger: DataFrame | None, out_root: str, run_id: str) -> dict[str, str]:
    """L1: ERP -> CRM lead updates.

    lead change set (B - A) -> rows whose fingerprint is not yet in the
    ledger (D3) -> update payloads (B2) -> outbound table; the new
    fingerprints are appended to the ledger.  The change set is
    checkpointed once (Q4: the source scanned its view four times).
    """
    diff = cut_lineage(FP.with_row_fingerprint(V.lead_diff(t), LEAD_DIFF_COLS))
    fresh = diff if ledger is None else FP.unseen(diff.drop("fingerprint"), ledger, LEAD_DIFF_COLS)
    from .queries_more import rep_options
    fresh = J.domain_or_default(fresh, "sales_rep", rep_options(t), "code", 99, out="sales_rep_checked")
    root = out_root.rstrip("/")
    paths = {"outbound": f"{root}/outbound/run={run_id}", "ledger": f"{root}/ledger/run={run_id}"}
    # A10: run counters collected while the rows are written (no extra pass).
    out = update_payload(fresh).observe("outbound_metrics", F.count(F.lit(1)).alias("payloads"))
    out.write.mode("overwrite").parquet(paths["outbound"])
    fresh.select("fingerprint", F.lit(run_id).alias("run_id")).write.mode("overwrite").parquet(paths["ledger"])
    return paths


def daily_reconcile(t: DomainTables, staged: DataFrame, diff_cols: list[str], out_root: str,
                    run_id: str) -> dict[str, str]:
    """L3: staged CRM export -> field diff against the stored leads (D4) ->
    upsert (M1) -> new lead snapshot version, plus the diff itself."""
    d = cut_lineage(field_diff(staged, t.leads, "id", diff_cols))
    new = merge_snapshot(t.leads, d.drop("tgt_id", "changed"), ["id"], diff_cols)
    root = out_root.rstrip("/")
    paths = {"diff": f"{root}/diff/run={run_id}", "leads": f"{root}/leads/v={run_id}"}
    d.write.mode("overwrite").parquet(paths["diff"])
    new.write.mode("overwrite").parquet(paths["leads"])
    return paths
