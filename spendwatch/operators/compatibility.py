"""Compatibility verdicts between consecutive schema versions, from a field catalog table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Writer type -> types a reader may declare for it.
PROMOTIONS = {
    "int": ["long", "float", "double"],
    "long": ["float", "double"],
    "float": ["double"],
    "string": ["bytes"],
    "bytes": ["string"],
}


def _readable(writer: str, reader: str, strict_types: bool) -> Column:
    """Whether a reader's view of a field can read what the writer wrote, where both have the field."""
    wrote, reads = F.col(f"{writer}.type"), F.col(f"{reader}.type")
    types_fit = wrote == reads
    if not strict_types:
        for source, targets in PROMOTIONS.items():
            types_fit = types_fit | ((wrote == source) & reads.isin(targets))
    known = F.size(F.array_except(
        F.coalesce(f"{writer}.symbols", F.array().cast("array<string>")),
        F.coalesce(f"{reader}.symbols", F.array().cast("array<string>")))) == 0
    # A reader with a default symbol reads any symbol it does not know as that one.
    symbols_fit = (wrote != "enum") | (reads != "enum") | known | F.col(f"{reader}.enum_default").isNotNull()
    return types_fit & symbols_fit


def schema_verdict(catalog: DataFrame, strict_types: bool = False, gathered: bool = False) -> DataFrame:
    """Verdict per subject and version against the existing version before it; versions may have gaps.

    All steps need the rows of a subject together, so the catalog is shuffled once, or not at all if it is `gathered`:
    partitioned by subject already. A task sorts its fields by name and version, where each meets the one it had before,
    and then the answers, a few flags per field, by version; everything else reads these two orders row by row.
    """
    # By subject alone, as the next window: Spark would put a finer one behind it, where each needs its own sort again.
    of_field = Window.partitionBy("subject").orderBy("field", "version")
    by_version = Window.partitionBy("subject").orderBy("version")
    of_version = Window.partitionBy("subject", "version")
    side = F.struct("type", "has_default", "symbols", "enum_default")
    same_before, same_after = (F.col("field").eqNullSafe(F.col(c)) for c in ("_field_before", "_field_after"))
    answers = (
        (catalog if gathered else catalog.repartition("subject"))
        .groupBy("subject", "field", "version").agg(F.max(side).alias("new"))
        .withColumns({
            "_field_before": F.lag("field").over(of_field), "_field_after": F.lead("field").over(of_field),
            "_from": F.lag("version").over(of_field), "_until": F.lead("version").over(of_field),
            "old": F.lag("new").over(of_field)})
        .select(
            "subject", "version", F.when(same_before, F.col("_from")).alias("_from"),
            F.when(same_after, F.col("_until")).alias("_until"),
            (same_before & F.col("old").isNotNull()).alias("_had"), F.col("new.has_default").alias("_default"),
            _readable("old", "new", strict_types).alias("_back"), _readable("new", "old", strict_types).alias("_forth"))
    )
    # A field that its next version lacks counts there: it is dropped after this one.
    earlier = by_version.rangeBetween(Window.unboundedPreceding, -1)
    later = by_version.rangeBetween(1, Window.unboundedFollowing)
    kept = F.col("_had") & F.col("_from").eqNullSafe(F.col("_before"))
    dropped = ~F.col("_until").eqNullSafe(F.col("_next"))
    versions = (
        answers.withColumns({
            "_before": F.max("version").over(earlier), "_next": F.min("version").over(later),
            "_rank": F.rank().over(by_version), "_row": F.row_number().over(by_version)})
        .withColumns({
            "_own_back": F.bool_and(F.when(kept, F.col("_back")).otherwise(F.col("_default"))).over(of_version),
            "_own_forth": F.bool_and(F.when(kept, F.col("_forth")).otherwise(True)).over(of_version),
            "_drops": F.bool_or(F.when(dropped, True)).over(of_version),
            "_drops_forth": F.bool_and(F.when(dropped, F.col("_default"))).over(of_version)})
        .where("_row = _rank")  # one row per version
    )
    # Without a null the smaller of two flags is their conjunction; nulls are left out, as bool_and does.
    pairs = (
        versions.withColumns({
            "backward": F.least("_own_back", F.lag("_drops").over(by_version)),
            "forward": F.least("_own_forth", F.lag("_drops_forth").over(by_version))})
        .where("_rank > 1 AND version IS NOT NULL")
    )
    verdict = (
        F.when(F.col("backward") & F.col("forward"), "FULL")
        .when(F.col("backward"), "BACKWARD")
        .when(F.col("forward"), "FORWARD")
        .otherwise("NONE")
    )
    return pairs.select("subject", "version", "backward", "forward", verdict.alias("verdict"))
