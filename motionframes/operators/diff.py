"""Snapshot differences, digests and their classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import json_leaves
from ..session import checkpoint_dir


def compare_snapshots(a: DataFrame, b: DataFrame, *, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """J7, J21. Every key of either side as same, differs, only_a or only_b, with both sides' values."""
    left = a.select(*keys, F.struct(*values).alias("a"))
    right = b.select(*keys, F.struct(*values).alias("b"))
    verdict = (
        F.when(F.col("b").isNull(), "only_a")
        .when(F.col("a").isNull(), "only_b")
        .when(F.col("a").eqNullSafe(F.col("b")), "same")
        .otherwise("differs")
    )
    return left.join(right, list(keys), "full_outer").withColumn("verdict", verdict)


def differing_values(diff: DataFrame, *, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """J21. One row per value that differs, of the keys both sides have."""
    cells = [
        F.struct(
            F.lit(v).alias("value"),
            F.col("a")[v].cast("string").alias("old"),
            F.col("b")[v].cast("string").alias("new"),
            (~F.col("a")[v].eqNullSafe(F.col("b")[v])).alias("_d"),
        )
        for v in values
    ]
    return diff.where("verdict = 'differs'").select(*keys, F.inline(F.array(*cells))).where("_d").drop("_d")


def changed_tokens(a: Column, b: Column) -> Column:
    """J8. Sorted names of the tokens that differ between two token maps."""
    names = F.array_sort(F.array_union(F.map_keys(a), F.map_keys(b)))
    return F.filter(names, lambda k: ~F.try_element_at(a, k).eqNullSafe(F.try_element_at(b, k)))


def token_category(a: Column, b: Column, *, missing: Column) -> Column:
    """J8. ``declared`` when the one differing token is ``code``; ``unlocalised`` when a side has none."""
    changed = changed_tokens(a, b)
    only_code = (F.size(changed) == 1) & (F.get(changed, F.lit(0)) == "code")
    return (
        F.when(missing, "unlocalised").when(a.isNull() | b.isNull(), "undeclared").when(only_code, "declared").otherwise("undeclared")
    )


def without_prefix(value: Column, prefix: Column) -> Column:
    """P10. A recorded path prefix removed wherever it occurs."""
    return F.when(F.length(prefix) > 0, F.replace(value, prefix, F.lit(""))).otherwise(value)


def masked(leaves: DataFrame, *, names: Sequence[str]) -> DataFrame:
    """P10. Volatile fields are replaced before comparing."""
    leaf = F.element_at(F.split("path", r"\."), -1)
    return leaves.withColumn("value", F.when(leaf.isin(*names), F.lit("<masked>")).otherwise(F.col("value")))


def classify(diff: DataFrame, rules: Sequence[tuple[str, Column]], *, otherwise: str = "undeclared") -> DataFrame:
    """J8. The first rule that holds names the category of a difference."""
    chain = F
    for name, condition in rules:
        chain = chain.when(condition, name)
    return diff.withColumn("category", chain.otherwise(otherwise) if rules else F.lit(otherwise))


def excused_by(diff: DataFrame, evidence: DataFrame, *, file: Column, key: str) -> DataFrame:
    """J9. A difference is excused only when its own source file has a declared difference."""
    proof = evidence.where("category = 'declared'").select(F.col(key).alias("_file"), F.lit(True).alias("_proof")).distinct()
    joined = diff.withColumn("_file", file).join(proof, "_file", "left")
    return joined.withColumn("excused", F.coalesce("_proof", F.lit(False))).drop("_file", "_proof")


def _digest(entry: str) -> Column:
    ordered = F.array_sort(F.collect_list(F.struct("_k", entry)))
    return F.sha2(F.concat_ws("|", F.transform(ordered, lambda e: e[entry])), 256)


def group_digest(df: DataFrame, *, keys: Sequence[str], name: str, digest: str, buckets: int) -> DataFrame:
    """A25. Digest of a group's digests in name order, in two levels.

    Members are spread over ``buckets`` by a hash of their name, each bucket is digested, and the
    bucket digests are digested in bucket order; no task holds a whole group. With one bucket it is
    the plain ordered digest, for groups of a declared size (the files of one take).
    """
    spread = F.pmod(F.crc32(F.col(name).cast("string")), F.lit(int(buckets)))
    parts = df.select(*keys, F.col(name).alias("_k"), F.col(digest).alias("_d"), spread.alias("_b"))
    first = parts.groupBy(*keys, "_b").agg(_digest("_d").alias("_d"), F.count(F.lit(1)).alias("_n"))
    second = first.withColumnRenamed("_b", "_k")
    return second.groupBy(*keys).agg(
        (F.max("_d") if buckets == 1 else _digest("_d")).alias("digest"), F.sum("_n").alias("members")
    )


def identity_hash(columns: Sequence[str], length: int) -> Column:
    """A26. Truncated digest of the named values as tight JSON with sorted keys and written-out nulls."""
    text = F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})
    return F.substring(F.sha2(text, 256), 1, length)


def subtree_digests(leaves: DataFrame, *, keys: Sequence[str], depth: int) -> DataFrame:
    """A27. One digest per path prefix of up to ``depth`` parts, over the leaves below it.

    A document's leaves are bounded by the document.
    """
    parts = F.split("path", r"\.")
    lengths = F.sequence(F.lit(1), F.least(F.size(parts), F.lit(depth)))
    named = leaves.select(
        *keys, F.col("path").alias("_k"), F.concat_ws("=", "path", "value").alias("_d"),
        F.explode(F.transform(lengths, lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."))).alias("subtree"),
    )
    return named.groupBy(*keys, "subtree").agg(_digest("_d").alias("digest"))


def differing_subtrees(a: DataFrame, b: DataFrame, *, keys: Sequence[str], document: str, depth: int) -> DataFrame:
    """A27. Path prefixes of up to ``depth`` parts below which two snapshots of JSON documents have different leaves.

    These are the prefixes whose ``subtree_digests`` differ, found without digests: equal documents of a key are taken off both
    sides unopened, then equal leaves, and only the leaves left over are spread over their prefixes.
    """
    checkpoint_dir(a.sparkSession)
    sides = [side.select(*keys, F.col(document).alias("_doc"), F.lit(weight).cast("bigint").alias("_w")) for side, weight in ((a, 1), (b, -1))]
    left_over = lambda df, *by: df.groupBy(*keys, *by).agg(F.sum("_w").alias("_w")).where("_w <> 0")
    changed = left_over(sides[0].unionByName(sides[1]), "_doc").checkpoint()
    leaves = json_leaves(changed, *keys, "_w", document=F.col("_doc"))
    parts = F.split("path", r"\.")
    lengths = F.sequence(F.lit(1), F.least(F.size(parts), F.lit(depth)))
    prefixes = F.transform(lengths, lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."))
    differing = left_over(leaves, "path", "value").checkpoint()
    return differing.select(*keys, F.explode(prefixes).alias("subtree")).distinct()


def leaf_most(differing: DataFrame, *, keys: Sequence[str], path: str) -> DataFrame:
    """A27. Paths without another differing path below them: joined on each path's own prefixes."""
    parts = F.split(path, r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."))
    covered = differing.where(F.size(parts) > 1).select(*keys, F.explode(above).alias(path)).distinct()
    return differing.join(covered, [*keys, path], "left_anti")
