"""Gates candidates by a hierarchical rule table and by presence counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators import relational as rel

LEVELS = ("family", "order", "class")  # the first with a rule decides
NO_RULE = "no rule matched; default exclude"


def parsed_rules(raw: DataFrame) -> DataFrame:
    """(level, name, flying, notes, line) of known levels; `flying` is true, false or unknown. Of equal names the last line counts."""
    text = lambda c: F.lower(F.trim(F.col(c)))
    state = F.when(text("flying") == "true", True).when(text("flying") == "false", False)
    rules = raw.select(text("level").alias("level"), text("name").alias("name"), state.alias("flying"), F.coalesce("notes", F.lit("")).alias("notes"), "line")
    rules = rules.where(F.col("level").isin(*LEVELS))
    return rules.groupBy("level", "name").agg(F.max_by(F.struct("flying", "notes"), "line").alias("rule")).select("level", "name", "rule.*")


def with_rule(df: DataFrame, rules: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """Adds is_flying and flight_rule. A rule that is there decides even if its state is unknown: then is_flying is false."""
    out, found = df, []
    for level in levels:
        own = rules.where(F.col("level") == level).select(F.col("name").alias(f"__{level}"), F.struct(F.col("flying"), F.concat(F.lit(f"{level}="), F.col("name"), F.lit("; "), F.col("notes")).alias("text")).alias(f"__rule_{level}"))
        out = out.join(own, F.lower(F.trim(F.col(f"`{level}`"))) == F.col(f"__{level}"), "left")
        found.append(F.col(f"__rule_{level}"))
    rule = F.coalesce(*found)
    out = out.withColumns({"is_flying": F.coalesce(rule["flying"], F.lit(False)), "flight_rule": F.coalesce(rule["text"], F.lit(NO_RULE))})
    return out.drop(*(f"__{x}" for x in levels), *(f"__rule_{x}" for x in levels))


def with_verdict(df: DataFrame, flying: str = "is_flying", presence: str = "ca_inat_count", error: str | None = "error") -> DataFrame:
    """Adds has_presence, kept and exclusion_reason ('; '-joined, empty for kept rows)."""
    present = F.coalesce(F.col(presence), F.lit(0)) >= 1
    kept = F.col(flying) & present
    reasons = [F.when(~F.col(flying), "not_flying"), F.when(~present, "no_CA_iNat_observation")]
    if error:
        reasons.append(F.when(F.col(error).isNotNull(), F.concat(F.lit("error: "), F.col(error))))
    return df.withColumns({"has_presence": present, "kept": kept, "exclusion_reason": F.when(kept, F.lit("")).otherwise(F.concat_ws("; ", *reasons))})


def best_match(results: DataFrame, key: str, full_name: Column, variant: Column, result: Column, variant_at: str, result_at: str) -> DataFrame:
    """One result a key. The first variant with any result counts; in it one that equals the whole name, then one that equals the variant, then the first."""
    tier = F.when(F.lower(result) == F.lower(full_name), 0).when(F.lower(result) == F.lower(variant), 1).otherwise(2)
    quality = F.element_at(F.array(F.lit("exact_full"), F.lit("exact_variant"), F.lit("first_result")), tier + 1)
    rated = results.withColumns({"__tier": tier, "match_quality": quality})
    rest = [c for c in rated.columns if c not in (key, "__tier")]
    best = rated.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(variant_at, "__tier", F.isnull(result_at), result_at)).alias("best"))
    return best.select(key, "best.*")


def contenders(asked: DataFrame, offered: DataFrame, key: str, names: Sequence[Column], limit: Column, result: Column, value: Column, result_at: Column) -> DataFrame:
    """Of all pairs with an equal key and value > limit those that best_match can pick: for each asked row the first result of all, and the first that equals each of its names.

    Columns: those of asked, result and result_at. Pairs aren't formed: both sides are put in falling order of value and
    limit, where an asked row takes the least result_at of the rows before it. Names are compared in lower case.
    """
    words = lambda *c: F.explode(F.array_distinct(F.array(*(F.lower(x) for x in c), F.lit(None).cast("string")))).alias("word")  # noqa: E731  # null: any name
    row, offer = F.struct(*asked.columns), F.struct(F.isnull(result_at).alias("unplaced"), result_at.alias("result_at"), result.alias("result"))
    left = asked.select(F.col(key).alias("key"), limit.alias("level"), row.alias("row"), *(c.alias(f"name_{k}") for k, c in enumerate(names))).where("key IS NOT NULL AND level IS NOT NULL")
    left = left.select("key", "level", "row", F.lit(0).alias("kind"), words(*(F.col(f"name_{k}") for k in range(len(names)))))
    right = offered.select(F.col(key).alias("key"), value.alias("level"), offer.alias("offer")).where("key IS NOT NULL AND level IS NOT NULL")
    right = right.select("key", "level", "offer", F.lit(1).alias("kind"), words(F.col("offer.result")))
    # Of equal levels asked rows come first, as only greater values count; the hash lets many equal ones fill several ranges.
    order = [F.desc("level"), F.col("kind"), F.xxhash64("row")]
    found = rel.running_least(left.unionByName(right, allowMissingColumns=True), ["key", "word"], order, "offer").where("row IS NOT NULL AND least IS NOT NULL")
    return found.select("row.*", "least.result", "least.result_at")
