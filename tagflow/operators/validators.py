"""Validators as functions, folded into one verdict by batch.

A validator takes the frames of a feed by name and gives (batch_id, ok, reason). ``fold`` runs a
list of them; a batch passes where every one of them judged it and none refused it, and its reason
is that of the first that did. Feeds name their validators (``NAMED``); ``register`` adds others.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.operators import coverage
from tagflow.sqlops import Operator, operator

_c = F.col
Validator = Callable[[Mapping[str, DataFrame]], DataFrame]


def of(op: Operator, batch: str = "batch_id", **params) -> Validator:
    """A validator of an operator that gives (``batch``, ok, reason); its inputs are frames of the same names."""
    return lambda frames: op(**{k: frames[k] for k in op.inputs()}, **params).select(_c(batch).alias("batch_id"), "ok", "reason")


#: Fixed names: the feeds' validators.
NAMED: dict[str, tuple[Validator, ...]] = {
    "history_window_coverage": (of(coverage.history_coverage), of(coverage.history_columns), of(coverage.history_rows), of(coverage.history_values)),
    "equipment_query_coverage": (of(coverage.rules_coverage), of(coverage.rules_rows)),
    "metadata_references": (of(coverage.metadata_page_chain, "site_ref"), of(coverage.entity_link_verdicts), of(coverage.entity_shape_verdicts)),
}


def register(name: str, *validators: Validator) -> None:
    """Name a list of validators; a name that is taken is refused."""
    if name in NAMED or not validators:
        raise ValueError(f"{name} is taken, or has no validators")
    NAMED[name] = validators


def fold(batches: DataFrame, validators: Sequence[Validator], frames: Mapping[str, DataFrame]) -> DataFrame:
    """(batch_id, ok, reason) of every batch of ``batches``; ``no_verdict`` where a validator did not judge it.

    Several verdicts of one validator on a batch count as refused if one is; a null ``ok`` is a refusal.
    """
    if not validators:
        raise ValueError("without a validator nothing is valid")
    told = None
    for k, v in enumerate(validators):
        one = v(frames).select("batch_id", F.lit(k).alias("at"), F.coalesce("ok", F.lit(False)).alias("ok"), F.coalesce("reason", F.lit("")).alias("reason"))
        told = one if told is None else told.unionByName(one)
    bad = F.min(F.when(~_c("ok"), F.struct("at", "reason")))
    each = told.groupBy("batch_id").agg(bad.alias("bad"), F.count_distinct("at").alias("judged"))
    reason = F.when(_c("bad").isNotNull(), F.when(_c("bad.reason") == "", "refused").otherwise(_c("bad.reason"))).when(F.coalesce("judged", F.lit(0)) < len(validators), "no_verdict").otherwise("")
    return batches.select("batch_id").distinct().join(each, "batch_id", "left").select("batch_id", (reason == "").alias("ok"), reason.alias("reason"))


def settled(rows: DataFrame, verdicts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of batches that passed, all others); a row without a batch, or of one without a verdict, is among the others."""
    good = verdicts.where("ok").select("batch_id")
    return rows.join(good, "batch_id", "left_semi"), rows.join(good, "batch_id", "left_anti")


@operator
def history_verdicts(plan, pages, columns, rows, validator="history_window_coverage"):
    """Planned history batches by their receipts, columns and samples, the first fault first."""
    return fold(plan, NAMED[validator], {"plan": plan, "pages": pages, "columns": columns, "rows": rows})


@operator
def rule_verdicts(plan, pages, found, validator="equipment_query_coverage"):
    """Planned rule days by their receipts and detections."""
    return fold(plan, NAMED[validator], {"plan": plan, "pages": pages, "found": found})


@operator
def metadata_verdicts(chain, entities, validator="metadata_references"):
    """Sites by their chain of pages, their entities' links and shapes."""
    return fold(chain.select(_c("site_ref").alias("batch_id")), NAMED[validator], {"chain": chain, "entities": entities})


@operator
def quarantine_split(rows, verdicts):
    """Rows with their batch's verdict; a row of a batch without one is quarantined."""
    good, bad = settled(rows.select("batch_id", "row_no", "point_id", "observed_at"), verdicts)
    return good.withColumn("ok", F.lit(True)).unionByName(bad.withColumn("ok", F.lit(False)))


@operator
def accepted_rows(rows, verdicts):
    """Rows of batches without a fault."""
    return settled(rows.select("batch_id", "row_no", "point_id", "observed_at"), verdicts)[0]
