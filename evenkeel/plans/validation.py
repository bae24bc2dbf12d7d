"""One validation run: classify once, read every check and detail off that frame."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.typed import typed
from ..mapping import Mapping
from ..operators import checks as C
from ..operators import compare, drift
from ..operators.classify import classify, slim
from ..operators.digest import classify_by_digest
from ..operators.layout import require_columns
from ..operators.small import small_frame
from ..sources.save import settle

DRIFTS = {
    "exact": drift.drift_exact,
    "family": drift.drift_family,
    "typed": drift.drift_typed,
}


class Validation:
    """Lazy frames of one comparison of ``source`` with ``target``.

    Use it as a context manager to keep the classified frame while several results are read; with
    ``settled`` it is written to the shared checkpoint folder instead of being cached, which spares
    a recomputation when executors are lost.
    ``drift_rule`` is exact, family or typed. ``partition_by`` (source column, target column) adds
    an informational count of business partitions whose row numbers differ. ``digest_levels`` compares
    digests first, so that only rows of differing buckets are exchanged with their values.
    """

    def __init__(
        self,
        source: DataFrame,
        target: DataFrame,
        mapping: Mapping,
        *,
        null_keys: str = "equal",
        drift_rule: str = "typed",
        strict: bool = True,
        partition_by: tuple[str, str] | None = None,
        settled: bool = False,
        digest_levels: tuple[int, ...] | None = None,
    ):
        self.source, self.target, self.mapping = source, target, mapping
        self.null_keys, self.drift_rule, self.partition_by = null_keys, drift_rule, partition_by
        self.settled, self.digest_levels = settled, digest_levels
        self.missing = {
            "source": require_columns(source, mapping, "source", strict),
            "target": require_columns(target, mapping, "target", strict),
        }
        lacking = set(self.missing["source"]), set(self.missing["target"])
        self.compared = Mapping(
            keys=mapping.keys,
            compare=tuple(
                c for c in mapping.compare if c.source not in lacking[0] and c.target not in lacking[1]
            ),
            gaps=mapping.gaps,
            names=mapping.names,
            unfit=mapping.unfit,
        )

    @cached_property
    def classified(self) -> DataFrame:
        if self.digest_levels:
            return classify_by_digest(
                self.source, self.target, self.compared, levels=self.digest_levels, null_keys=self.null_keys
            )
        return slim(classify(self.source, self.target, self.compared, self.null_keys))

    def __enter__(self) -> Validation:
        if self.settled:
            self.classified = settle(self.classified)
        else:
            self.classified.persist(StorageLevel.MEMORY_AND_DISK)
        return self

    def __exit__(self, *exc) -> None:
        if not self.settled:
            self.classified.unpersist()

    @cached_property
    def source_cast_failures(self) -> DataFrame:
        return C.cast_failures(self.source, self.mapping, "source")

    @cached_property
    def target_cast_failures(self) -> DataFrame:
        return C.cast_failures(self.target, self.mapping, "target")

    @cached_property
    def schema_drift(self) -> DataFrame:
        """Drift rows of the mapped columns; for the typed rule, of their typed columns."""
        rows = []
        for c in self.mapping.columns:
            sides = []
            for df, name in ((self.source, c.source), (self.target, c.target)):
                if name not in df.columns:
                    sides.append(None)
                elif self.drift_rule == "typed":
                    # What the cast of this column really gives; nothing is computed for it.
                    value = typed(F.col(f"`{name}`"), c.kind, c.date_format, df.schema[name].dataType)
                    sides.append(df.select(value.alias("v")).schema["v"].dataType.simpleString())
                else:
                    sides.append(df.schema[name].dataType.simpleString())
            rows.append(("", self.mapping.name(c), c.data_type, *sides))
        types = small_frame(
            self.source.sparkSession,
            rows,
            "pair string, column_name string, declared_data_type string, "
            "source_data_type string, target_data_type string",
        )
        return DRIFTS[self.drift_rule](types).drop("pair")

    @property
    def extra_in_source(self) -> DataFrame:
        return compare.extra_in_source(self.classified, self.compared)

    @property
    def extra_in_target(self) -> DataFrame:
        return compare.extra_in_target(self.classified, self.compared)

    @property
    def matched_keys(self) -> DataFrame:
        return compare.matched_keys(self.classified, self.compared)

    @property
    def mismatch_long(self) -> DataFrame:
        return compare.mismatch_long(self.classified, self.compared)

    @property
    def mismatch_wide(self) -> DataFrame:
        return compare.mismatch_wide(self.classified, self.compared)

    def duplicate_keys(self, side: str) -> DataFrame:
        row, count = ("src", "n_src") if side == "source" else ("tgt", "n_tgt")
        found = self.classified.filter(F.col(count) > 1)
        return found.select(*compare.raw_keys(self.compared, row), F.col(count).alias("count"))

    def details(self) -> dict[str, DataFrame]:
        return {
            "detailed_mismatch": self.mismatch_long,
            "extra_records_in_source": self.extra_in_source,
            "extra_records_in_target": self.extra_in_target,
            "source_duplicate_keys": self.duplicate_keys("source"),
            "target_duplicate_keys": self.duplicate_keys("target"),
            "source_cast_failure_report": self.source_cast_failures,
            "target_cast_failure_report": self.target_cast_failures,
            "schema_datatype_drift": self.schema_drift,
        }

    @cached_property
    def checks(self) -> DataFrame:
        """validation_name, counter, value, status of every check."""
        drifted = drift.drift_check(self.schema_drift.withColumn("pair", F.lit("")))
        failed = F.col("status") == "FAIL"
        counters = ["total_columns_checked", "total_drift_columns"]
        if self.drift_rule == "family":
            counters += ["total_warn_columns"]
        counters += ["failed_declared_type_cast_columns"]
        parts = [
            C.key_checks(C.key_totals(self.classified)),
            C.cast_failure_check(self.source_cast_failures, "source"),
            C.cast_failure_check(self.target_cast_failures, "target"),
            C.check_rows(drifted, "schema_datatype_drift_validation", counters, failed),
        ]
        if self.partition_by:
            counts = C.partition_count_check(self.source, self.target, *self.partition_by)
            differing = counts.agg(
                F.count_if(F.col("status") == "FAIL").alias("differing_partition_count")
            )
            rows = C.check_rows(
                differing, "partition_count_validation", ["differing_partition_count"], F.lit(False)
            )
            parts.append(rows.withColumn("status", F.lit("INFO")))
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole

    @cached_property
    def overall_status(self) -> DataFrame:
        return C.overall_status(self.checks)

    @cached_property
    def summary(self) -> DataFrame:
        """One row with the counters, the status of each check and the overall status."""

        def value(check: str, counter: str, name: str):
            hit = (F.col("validation_name") == check) & (F.col("counter") == counter)
            return F.max(F.when(hit, F.col("value"))).alias(name)

        def status(check: str, name: str):
            return F.max(F.when(F.col("validation_name") == check, F.col("status"))).alias(name)

        extra, bad = "missing_extra_by_key_validation", "hash_mismatch_validation"
        drifted = "schema_datatype_drift_validation"
        worst = F.max(F.when(F.col("status") == "FAIL", F.lit(1)).otherwise(F.lit(0)))
        columns = [
            value("row_count_validation", "source_row_count", "source_count"),
            value("row_count_validation", "target_row_count", "target_count"),
            status("row_count_validation", "row_count_status"),
            status(drifted, "schema_drift_status"),
            value(drifted, "total_columns_checked", "schema_total_columns_checked"),
            value(drifted, "total_drift_columns", "schema_drift_columns"),
            value(
                drifted, "failed_declared_type_cast_columns", "failed_declared_type_cast_columns"
            ),
        ]
        for side in ("source", "target"):
            name = f"{side}_cast_failure_validation"
            columns += [
                status(name, f"{side}_cast_failure_status"),
                value(name, "failed_columns", f"{side}_failed_columns"),
                value(name, "total_cast_failures", f"{side}_total_cast_failures"),
            ]
        for side in ("source", "target"):
            name = f"{side}_duplicate_key_validation"
            columns.append(value(name, "duplicate_key_count", f"{side}_duplicate_keys"))
        columns += [
            value(extra, "extra_records_in_source_count", "extra_records_in_source"),
            value(extra, "extra_records_in_target_count", "extra_records_in_target"),
            value(extra, "matched_key_count", "matched_key_count"),
            value(bad, "mismatch_record_count", "mismatch_record_count"),
            value(bad, "mismatch_field_count", "mismatch_field_count"),
            F.when(worst == 1, "FAIL").otherwise("PASS").alias("overall_status"),
        ]
        return self.checks.agg(*columns)
