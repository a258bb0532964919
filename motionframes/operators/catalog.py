"""Registration, journals and verified rewrites as new snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .blocks import HOT_ROWS, running

# A sequence number after every real one.
END = 2**62

LINEAGE = ("source", "spec_id", "spec_version")


def merge_registration(
    existing: DataFrame, assets: DataFrame, *, folder: str, lineage: Mapping[str, str] | None, fields: Sequence[str]
) -> DataFrame:
    """J11. The asset list after registering ``assets`` of one dataset over ``existing``.

    ``existing`` has a position ``idx`` and a ``superseded`` flag. A live entry stands for an asset
    by its id under ``folder``, else by its path and lineage. The newest entry equal in all
    ``fields`` is kept, the other matches are replaced; a live entry of the lineage under the folder
    that nothing stands for is dropped; assets without a kept entry are added. ``outcome`` says which.
    """
    prefix = "" if folder in ("", ".") else folder.rstrip("/") + "/"
    new = assets.select(F.struct(*fields).alias("n"))
    by_id = new.select(F.col("n.asset_id").alias("asset_id"), F.col("n").alias("_by_id"))
    by_path = new.select(
        *[F.col("n")[c].alias(c) for c in LINEAGE], F.col("n.relative_path").alias("relative_path"), F.col("n").alias("_by_path")
    )
    inside = F.col("relative_path").startswith(prefix)
    joined = existing.join(by_id, "asset_id", "left").join(by_path, [*LINEAGE, "relative_path"], "left")
    match = F.when(~F.col("superseded"), F.coalesce(F.when(inside, F.col("_by_id")), F.col("_by_path")))
    joined = joined.withColumn("_m", match)
    same = F.col("_m").isNotNull() & F.col("_m").eqNullSafe(F.struct(*fields))
    newest = Window.partitionBy(F.col("_m.asset_id"), "_same", "_lone").orderBy(F.desc("idx"))
    # Entries that match nothing get a partition each instead of meeting in one.
    joined = joined.withColumn("_same", same).withColumn("_lone", F.when(F.col("_m").isNull(), F.col("idx")))
    joined = joined.withColumn("_rn", F.row_number().over(newest))
    ours = F.lit(bool(prefix) and lineage is not None)
    for column, value in (lineage or {}).items():
        ours = ours & (F.col(column) == value)
    outcome = (
        F.when(F.col("superseded"), "untouched")
        .when(F.col("_same") & (F.col("_rn") == 1), "kept")
        .when(F.col("_m").isNotNull(), "replaced")
        .when(inside & ours, "dropped")
        .otherwise("untouched")
    )
    columns = list(dict.fromkeys(fields))
    after = joined.withColumn("outcome", outcome).select(
        "idx",
        *columns,
        (F.col("superseded") | F.col("outcome").isin("replaced", "dropped")).alias("superseded"),
        F.when(F.col("outcome") == "replaced", F.col("_m.asset_id")).alias("superseded_by"),
        "outcome",
    )
    kept = after.where("outcome = 'kept'").select("asset_id")
    added = assets.join(kept, "asset_id", "left_anti").select(
        F.lit(None).cast("bigint").alias("idx"), *columns, F.lit(False).alias("superseded"),
        F.lit(None).cast("string").alias("superseded_by"), F.lit("added").alias("outcome"),
    )
    return after.unionByName(added)


def supersede_version(assets: DataFrame, *, version: str, by: str, only: Column | None = None) -> DataFrame:
    """J12. Mark every live asset of a version superseded; ``changed`` says which rows moved."""
    hit = (F.col("spec_version") == version) & ~F.col("superseded")
    if only is not None:
        hit = hit & only
    return assets.withColumn("changed", hit).withColumns(
        {
            "superseded_by": F.when(F.col("changed"), F.lit(by)).otherwise(F.col("superseded_by")),
            "superseded": F.col("superseded") | F.col("changed"),
        }
    )


def changes_between(before: DataFrame, after: DataFrame, *, key: str, value: Sequence[str], sequence: int) -> DataFrame:
    """W25, Q9. Journal rows of one write: added, removed or changed keys with both values."""
    old = before.select(key, F.struct(*value).alias("old"))
    new = after.select(key, F.struct(*value).alias("new"))
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("changed")
    return (
        old.join(new, key, "full_outer")
        .where(~F.col("old").eqNullSafe(F.col("new")))
        .select(F.lit(sequence).cast("bigint").alias("sequence"), key, change.alias("change"), "old", "new")
    )


def as_of(current: DataFrame, journal: DataFrame, *, key: str | Sequence[str], value: Sequence[str], sequence: int) -> DataFrame:
    """W25. The table right after journal record ``sequence``: the first later change of a key holds
    the value it had; a key added later was not there. All records of ``journal`` reached the table
    (``as_of_story`` also reads journals with records that did not)."""
    keys = [key] if isinstance(key, str) else list(key)
    later = journal.where(F.col("sequence") > sequence)
    taken_back = later.groupBy(*keys).agg(F.min_by(F.struct("old"), F.col("sequence")).alias("_o"))
    now = current.select(*keys, F.struct(*value).alias("_now"))
    joined = now.join(taken_back, keys, "full_outer")
    then = F.when(F.col("_o").isNotNull(), F.col("_o.old")).otherwise(F.col("_now"))
    return joined.withColumn("_then", then).where(F.col("_then").isNotNull()).select(*keys, F.col("_then.*"))


def as_of_problems(records: DataFrame, digests: DataFrame, *, file: str, sequence: int, rows: int) -> DataFrame:
    """W25. Files that can't be rebuilt as of record ``sequence``, and why.

    The record must be in the journal and have reached the file, and every later one must be explained. Record 0 is the file
    before its first write. ``digests`` has one row per file there is.
    """
    return _problems(journal_story(records, digests, file=file, rows=rows), digests, file, sequence)


def _problems(story: DataFrame, digests: DataFrame, file: str, sequence: int) -> DataFrame:
    # A record's story as a number (1 applied, 2 unapplied, 3 unexplained): numbers are summed up without sorting.
    mine, later = F.col("sequence") == sequence, F.col("sequence") > sequence
    told_as = F.when(F.col("story") == "applied", 1).when(F.col("story") == "unapplied", 2).otherwise(3)
    told = story.where(mine | later).groupBy(file).agg(
        F.max(F.when(mine, told_as)).alias("_mine"), F.bool_or(later & (F.col("story") == "unexplained")).alias("_broken")
    )
    at_record = F.when(F.col("_mine").isNull(), "no such record").when(F.col("_mine") == 2, "record was never applied")
    at_record = at_record.when(F.col("_mine") == 3, "record can't be explained")
    problem = F.coalesce(*([at_record] if sequence else []), F.when(F.col("_broken"), "a later record can't be explained"))
    return digests.select(file).join(told, file, "left").select(file, problem.alias("problem")).where("problem is not null")


def as_of_story(
    current: DataFrame, changes: DataFrame, records: DataFrame, digests: DataFrame, *, file: str, key: str, value: Sequence[str], sequence: int, rows: int
) -> DataFrame:
    """W25. Every file right after its record ``sequence``; only records that reached a file are taken back.

    ``changes`` has the old and new value per file, sequence and key; ``records`` the digests before and after each write. Files in
    ``as_of_problems`` are left out. The records' story is told once and checkpointed.
    """
    checkpoint_dir(records.sparkSession)
    told = journal_story(records, digests, file=file, rows=rows).where(F.col("sequence") >= sequence)
    story = told.select(file, "sequence", "story").checkpoint()
    landed = story.where((F.col("sequence") > sequence) & (F.col("story") == "applied")).select(file, "sequence")
    taken_back = changes.where(F.col("sequence") > sequence).join(landed, [file, "sequence"], "left_semi")
    then = as_of(current, taken_back, key=[file, key], value=value, sequence=sequence)
    return then.join(_problems(story, digests, file, sequence), file, "left_anti")


def journal_story(journal: DataFrame, current: DataFrame, *, file: str, rows: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """W24. Which journalled writes reached the file.

    Walking back from the file's digest, the state left by every record is its own ``before``
    whatever happened to it. So the state a record meets is the next record's ``before``, or the
    current digest for the newest: one look ahead, no fold. The records of a file are counted first: while no file has more than
    ``hot_rows`` of them one window per file looks ahead, otherwise blocks of ``rows`` sequence numbers do.
    """
    # The file's present digest follows its last record on the same line of records, so nothing is joined.
    end = current.select(file, F.lit(END).alias("sequence"), F.col("digest").alias("before"))
    line = journal.withColumn("sequence", F.col("sequence").cast("bigint")).unionByName(end, allowMissingColumns=True)
    if journal.groupBy(file).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).isEmpty():
        ahead = line.withColumn("_state", F.lead("before").over(Window.partitionBy(file).orderBy("sequence")))
    else:
        ahead = running(line, keys=[file], frame="sequence", scans={"_state": ("following", F.col("before"))}, rows=rows)
    return ahead.where(F.col("sequence") < END).withColumn(
        "story",
        F.when(F.col("after").eqNullSafe(F.col("_state")), "applied")
        .when(F.col("before").eqNullSafe(F.col("_state")), "unapplied")
        .otherwise("unexplained"),
    ).drop("_state")


def split_by_trust(takes: DataFrame, ledger: DataFrame, *, key: str, digests: Sequence[str], full: bool) -> DataFrame:
    """Q8. ``trusted`` where all digests equal a prior PASS; everything is checked on a full run."""
    prior = ledger.where("status = 'PASS'").select(key, *[F.col(d).alias(f"_{d}") for d in digests], F.lit(True).alias("_p"))
    joined = takes.join(prior, key, "left")
    same = F.col("_p").isNotNull()
    for d in digests:
        same = same & F.col(d).eqNullSafe(F.col(f"_{d}"))
    return joined.withColumn("trusted", F.lit(not full) & same).drop("_p", *[f"_{d}" for d in digests])


def updated_ledger(ledger: DataFrame, checked: DataFrame, *, key: str) -> DataFrame:
    """Q8. The next snapshot: checked takes replace their old entries."""
    return ledger.join(checked.select(key), key, "left_anti").unionByName(checked.select(*ledger.columns))


def exclude_offenders(index: DataFrame, verdicts: DataFrame, *, key: str, owner: str) -> DataFrame:
    """Q10. Recompute our own exclusions and leave those of others.

    ``verdicts`` has a reason (null: sound) for every take that was judged.
    """
    joined = index.join(verdicts.select(key, F.col("reason").alias("_r"), F.lit(True).alias("_judged")), key, "left")
    ours = F.col("excluded_by").isNull() | (F.col("excluded_by") == owner)
    judged = F.coalesce("_judged", F.lit(False)) & ours & F.col("status").isin("ok", "excluded")
    bad = judged & F.col("_r").isNotNull()
    freed = judged & F.col("_r").isNull()
    return joined.select(
        *[c for c in index.columns if c not in ("status", "reason", "excluded_by")],
        F.when(bad, "excluded").when(freed, "ok").otherwise(F.col("status")).alias("status"),
        F.when(bad, F.col("_r")).when(~freed, F.col("reason")).alias("reason"),
        F.when(bad, owner).when(~freed, F.col("excluded_by")).alias("excluded_by"),
    )


def index_counts(index: DataFrame) -> DataFrame:
    """Q10, S15."""
    count = lambda s: F.count_if(F.col("status") == s)
    return index.agg(
        count("ok").alias("ok"), count("failed").alias("failed"), count("excluded").alias("excluded"), F.count(F.lit(1)).alias("total")
    )


def merge_shards(shards: Sequence[DataFrame], *, key: str, expected: int) -> tuple[DataFrame, Column]:
    """S15. One index from shard indexes: the last shard wins a repeated key; the flag says complete."""
    tagged = [s.withColumn("_shard", F.lit(i)) for i, s in enumerate(shards)]
    merged = tagged[0]
    for t in tagged[1:]:
        merged = merged.unionByName(t)
    columns = [c for c in merged.columns if c not in (key, "_shard")]
    last = merged.groupBy(key).agg(F.max_by(F.struct(*columns), F.col("_shard")).alias("_row"))
    return last.select(key, "_row.*"), F.lit(len(shards) == expected)


def backfill(rows: DataFrame, *, key: str, field: str, derived: Column, reason: Column, before: Column, after: Column) -> DataFrame:
    """Q12. Fill a missing field from a derivation; journal columns say what was added or why not.

    ``before`` / ``after`` are digests over the row without and with the new value.
    """
    empty = F.col(field).isNull()
    fill = empty & derived.isNotNull()
    journal = rows.withColumn("_d", derived).withColumn("before_sha", before)
    journal = journal.withColumn(
        "skip_reason", F.when(~empty, "present").when(~fill, F.coalesce(reason, F.lit("not derivable")))
    )
    filled = journal.withColumn(field, F.coalesce(field, "_d")).drop("_d")
    return filled.withColumn("after_sha", after)


def roll_back(current: DataFrame, journal: DataFrame, *, key: str, digest: Column, field: str) -> DataFrame:
    """Q12. Undo journalled fills; a row whose digest is not the journalled one is refused."""
    marks = journal.where("skip_reason is null").select(key, F.col("after_sha").alias("_after"))
    joined = current.withColumn("_now", digest).join(marks, key, "left")
    undo = F.col("_now") == F.col("_after")
    outcome = F.when(F.col("_after").isNull(), "untouched").when(undo, "undone").otherwise("refused")
    return joined.withColumn("outcome", outcome).withColumn(
        field, F.when(F.col("outcome") != "undone", F.col(field))
    ).drop("_now", "_after")


def column_sums(df: DataFrame, *, keys: Sequence[str], name: str, columns: Sequence[str]) -> DataFrame:
    """Per key and column two sums of independent hashes of (name, value): no order, and so no list of rows."""

    def sums(c: str) -> Column:
        text = F.col(c).cast("string")
        one = lambda seed: F.sum(F.xxhash64(F.lit(seed), F.col(name), text.isNull(), text).cast("decimal(20,0)"))
        return F.struct(one(1).alias("a"), one(2).alias("b")).alias(c)

    return df.groupBy(*keys).agg(*[sums(c) for c in columns])


def changed_columns(before: DataFrame, after: DataFrame, *, keys: Sequence[str], name: str) -> DataFrame:
    """Q13. Which columns a rewrite changed, and for how many keys."""
    columns = [c for c in before.columns if c not in (*keys, name)]
    a = column_sums(before, keys=keys, name=name, columns=columns)
    b = column_sums(after, keys=keys, name=name, columns=columns)
    joined = a.select(*keys, F.struct(*columns).alias("_a")).join(b.select(*keys, F.struct(*columns).alias("_b")), list(keys), "full_outer")
    changed = [F.count_if(~F.col("_a")[c].eqNullSafe(F.col("_b")[c])).alias(c) for c in columns]
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("changed")) for c in columns]
    return joined.agg(*changed).select(F.inline(F.array(*cells))).where("changed > 0")
