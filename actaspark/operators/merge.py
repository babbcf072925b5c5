"""Upserts without a database: closed forms of row-by-row merges, over batches with a sequence number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, key: str, date: str, seq: str) -> DataFrame:
    """Per key the oldest row; among rows of one date the last that came in. A hash aggregate, no sort."""
    rest = [c for c in df.columns if c != key]
    least = F.min_by(F.struct(*rest), F.struct(F.col(date), -F.col(seq)))
    return df.groupBy(key).agg(least.alias("_row")).select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def sticky_fold(df: DataFrame, key: str, seq: str, name: str, address: str, source: str, confidence: str, payload: str, strong: str = "ejustice", unknown: str = "Société inconnue") -> DataFrame:
    """What row-by-row merging leaves of each key, in one pass.

    Let k be the last row of the ``strong`` source, or else the first row. The name is the first known one
    from k on; the address the first non-blank one from k on, or else the last; the source sticks to the
    strong one; the confidence is the greatest; the payload the last."""
    w = Window.partitionBy(key)
    strong_at = F.max(F.when(F.col(source) == strong, F.col(seq))).over(w)
    rows = df.withColumn("_k", F.coalesce(strong_at, F.min(seq).over(w)))
    late = F.col(seq) >= F.col("_k")
    first = lambda value, good: F.min_by(value, F.when(late & good, F.col(seq)))
    return rows.groupBy(key).agg(
        F.coalesce(first(F.col(name), F.col(name) != unknown), F.lit(unknown)).alias(name),
        F.coalesce(first(F.col(address), F.coalesce(F.col(address), F.lit("")) != ""), F.max_by(F.col(address), F.col(seq))).alias(address),
        F.when(F.max(F.when(F.col(source) == strong, 1)) == 1, F.lit(strong)).otherwise(F.min_by(source, seq)).alias(source),
        F.max(confidence).alias(confidence),
        F.max_by(payload, seq).alias(payload),
    )


def upsert_last(df: DataFrame, key: str, seq: str, overwrite: tuple[str, ...]) -> DataFrame:
    """Per key the first row, with the ``overwrite`` columns of the last."""
    rest = [c for c in df.columns if c not in (key, seq)]
    return df.groupBy(key).agg(*[(F.max_by if c in overwrite else F.min_by)(F.col(c), F.col(seq)).alias(c) for c in rest])


def insert_if_absent(existing: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``batch`` whose natural key isn't there yet, each key once. Null equals null."""
    e, b = existing.select(*key).distinct().alias("e"), batch.dropDuplicates(key).alias("b")
    same = F.lit(True)
    for c in key:
        same = same & F.col(f"b.{c}").eqNullSafe(F.col(f"e.{c}"))
    return b.join(e, same, "left_anti")


def _filled(c: Column, kind: str) -> Column:
    if kind.startswith("array"):
        return F.when(F.size(c) > 0, c)
    return F.when(F.trim(c) != "", c) if kind == "string" else c


def patch(df: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``df`` with those of ``columns`` that ``new`` has non-empty for the key."""
    kinds, d, n = dict(new.dtypes), df.alias("d"), new.select(key, *columns).alias("n")
    joined = d.join(n, F.col(f"d.{key}") == F.col(f"n.{key}"), "left")
    return joined.select(*[F.coalesce(_filled(F.col(f"n.{c}"), kinds[c]), F.col(f"d.{c}")).alias(c) if c in columns else F.col(f"d.{c}") for c in df.columns])


def delete_cascade(key_values: DataFrame, key: str, *tables: DataFrame) -> list[DataFrame]:
    """Each table without the rows of the given keys."""
    return [t.join(key_values.select(key), key, "left_anti") for t in tables]


def role_priority(df: DataFrame, key: str, priority: Column, seq: str, csv: Column) -> DataFrame:
    """One row per key: a strictly higher priority replaces name and role, the first of equals stays.
    confidence = 25 * priority, and 75 more if a listed source has it."""
    rest = [c for c in df.columns if c != key]
    best = F.max_by(F.struct(*rest), F.struct(priority, -F.col(seq)))
    out = df.groupBy(key).agg(best.alias("_row"), F.max(priority).alias("_p"), F.max(csv.cast("int")).alias("_csv"))
    return out.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest], (F.col("_p") * 25 + F.col("_csv") * 75).cast("int").alias("confidence"))


def resolve_company(unknown: str = "Société inconnue") -> Column:
    """struct(bce, nom, adresse, source, confidence) of a decision with TVA, text, denoms_by_bce, adresses_by_bce,
    adresses_by_ejustice (bce, nom, adresse) and denom_fallback_bce (bce, noms): number and name from the
    registry first, the address from the lookup first."""
    from actaspark.functions import ids

    first = lambda c: F.try_element_at(c, F.lit(1))
    looked, names, back = first(F.col("adresses_by_ejustice")), first(F.col("denoms_by_bce")), first(F.col("denom_fallback_bce"))
    filled = lambda c: F.when(F.trim(c) != "", c)
    strong, known = F.coalesce(F.size("adresses_by_ejustice") > 0, F.lit(False)), F.coalesce(F.size("denoms_by_bce") > 0, F.lit(False))
    return F.struct(
        ids.format_number(F.coalesce(first(F.col("TVA")), filled(looked["bce"]), first(ids.extract_numbers(F.col("text"))))).alias("bce"),
        F.coalesce(filled(first(names["noms"])), filled(looked["nom"]), filled(first(back["noms"])), F.lit(unknown)).alias("nom"),
        F.coalesce(filled(looked["adresse"]), filled(first(first(F.col("adresses_by_bce"))["adresses"])["address"])).alias("adresse"),
        F.when(strong, "ejustice").when(known, "bce").otherwise("fallback").alias("source"),
        F.when(strong, 1.0).when(known, 0.8).otherwise(0.5).alias("confidence"),
    )
