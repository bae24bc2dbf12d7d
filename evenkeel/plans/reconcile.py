"""The whole chain on tables: validate, repair, validate again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..mapping import Mapping
from ..operators import repair
from ..sources.save import settle
from .validation import Validation


@dataclass
class Reconciliation:
    before: Validation
    plan: DataFrame
    repaired: DataFrame
    after: Validation

    @property
    def summary(self) -> DataFrame:
        return repair.repair_summary(self.plan)


def reconcile(
    source: DataFrame,
    target: DataFrame,
    mapping: Mapping,
    *,
    null_update: str = "keep",
    null_keys: str = "equal",
    settle_plan: bool = False,
    **options,
) -> Reconciliation:
    """Validate, repair and validate the repaired target; every frame is lazy.

    ``settle_plan`` writes the repair plan to the shared checkpoint folder first, so that the
    repaired table and its reports are read back instead of being computed again for each. With
    ``strict=False`` columns that one side lacks are neither compared nor repaired.
    """
    options["null_keys"] = null_keys
    before = Validation(source, target, mapping, **options)
    plan = repair.plan_repair(
        target, source, before.compared, null_update=null_update, null_keys=null_keys
    )
    if settle_plan:
        plan = settle(plan)
    repaired = repair.repaired(plan)
    return Reconciliation(
        before=before,
        plan=plan,
        repaired=repaired,
        after=Validation(source, repaired, mapping, **options),
    )
