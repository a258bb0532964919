"""Names, paths, tokens, categories and JSON leaves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.blocks import dealt, task_count
from ..session import checkpoint_dir

#: JSON documents that one task opens.
DOCUMENTS = 50_000
# Names that operating systems and sync clients leave behind.
METADATA_NAMES = (".ds_store", ".localized", "desktop.ini", "thumbs.db")
METADATA_PREFIX = "._"
UNFINISHED = r"^\..+\.[A-Za-z0-9_]+\.staging$"
# Fixed patterns: an absolute path with a drive letter or a leading folder, a bare version number,
# and a token that is banned from lineage fields.
ABSOLUTE_PATH = r"""(?<![A-Za-z])[A-Za-z]:[\\/]|(?:^|(?<=[\s"'=:(\[,;<>|]))/[^/\s"'<>|\\]+/"""
BARE_VERSION = r"^\d+\.\d+\.\d+$"
BANNED_TOKEN = r"(?i)\bcanonical\b"


def is_metadata(name: Column) -> Column:
    """S10."""
    return F.lower(name).isin(*METADATA_NAMES) | name.startswith(METADATA_PREFIX)


def is_unfinished(name: Column) -> Column:
    """S10. A copy that was never verified and renamed."""
    return name.rlike(UNFINISHED)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def normal_path(path: Column, *, fold_case: bool = False) -> Column:
    """P14. Forward slashes, and one case where the file system ignores it."""
    out = F.replace(path, F.lit("\\"), F.lit("/"))
    return F.lower(out) if fold_case else out


def below_root(path: Column, root: str) -> Column:
    """P14. Path relative to a root; null outside it."""
    prefix = root.rstrip("/") + "/"
    return F.when(path.startswith(prefix), F.substring(path, F.lit(len(prefix) + 1), F.length(path)))


def pointer_part(name: Column) -> Column:
    """P14. JSON Pointer escape."""
    return F.replace(F.replace(name, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))


def folder_name(name: Column) -> Column:
    """P14. Every character but letters, digits, dot, dash and underscore becomes an underscore."""
    return F.regexp_replace(name, r"[^A-Za-z0-9._-]", "_")


def composite_id(*parts: Column) -> Column:
    """P15."""
    return F.concat_ws(":", *parts)


def id_part(value: Column, index: int) -> Column:
    """P15."""
    return F.get(F.split(value, ":"), F.lit(index))


def biological_sex(value: Column, *, fallback: str | None) -> Column:
    """P7. First letter of the cleaned string decides; anything else gives the fallback (null: strict)."""
    clean = F.lower(F.trim(value))
    return (
        F.when(clean.startswith("f"), "female")
        .when(clean.startswith("m"), "male")
        .otherwise(F.lit(fallback).cast("string"))
    )


def body_gender(value: Column) -> Column:
    """P7. male, female or neutral by the first letter; null for anything else."""
    return F.when(F.lower(F.trim(value)).startswith("n"), "neutral").otherwise(biological_sex(value, fallback=None))


def height_m(value: Column) -> Column:
    """P9. Heights above three metres are centimetres."""
    return F.when(value > 3.0, value / 100.0).otherwise(value)


def tokens(value: Column) -> Column:
    """P19. ``k=v;k=v`` as a map; null when malformed or a key repeats."""
    parts = F.split(value, ";")
    keys = F.transform(parts, lambda p: F.substring_index(p, "=", 1))
    good = value.isNotNull() & F.forall(parts, lambda p: p.rlike("^[^=]+=")) & (
        F.size(F.array_distinct(keys)) == F.size(keys)
    )
    pairs = F.transform(
        parts, lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), F.regexp_replace(p, "^[^=]*=", "").alias("v"))
    )
    return F.when(good, F.map_from_entries(F.when(good, pairs)))


def safe_listed_name(name: Column) -> Column:
    """F16. ``folder/relative path`` without a drive, a backslash, or an empty, ``.`` or ``..`` part."""
    parts = F.split(name, "/")
    bad = F.exists(parts, lambda p: p.isin("", ".", ".."))
    return ~F.contains(name, F.lit("\\")) & ~F.contains(parts[0], F.lit(":")) & (F.size(parts) >= 2) & ~bad


def row_hash(*columns: str) -> Column:
    """F17. Digest of a row as JSON with its columns in name order and nulls written out."""
    ordered = sorted(columns)
    return F.sha2(F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"}), 256)


def up_axis_from_text(text: Column) -> Column:
    """F15. The up axis a description states, null when it states none."""
    return F.upper(F.nullif(F.regexp_extract(F.lower(text), r"\b([xyz])[- ]up\b", 1), F.lit("")))


def up_axis_from_gravity(x: Column, y: Column, z: Column) -> Column:
    """F15. The axis against gravity when a single component is non-zero."""
    return (
        F.when((y < 0) & (x == 0) & (z == 0), "Y").when((z < 0) & (x == 0) & (y == 0), "Z").when((x < 0) & (y == 0) & (z == 0), "X")
    )


def agreed(*witnesses: Column) -> tuple[Column, Column]:
    """F15. The value all present witnesses agree on, and the reason when there is none."""
    present = F.array_compact(F.array(*witnesses))
    distinct = F.array_distinct(present)
    value = F.when(F.size(distinct) == 1, F.get(distinct, F.lit(0)))
    reason = F.when(F.size(distinct) == 0, "no witness").when(F.size(distinct) > 1, "witnesses disagree")
    return value, reason


def json_leaves(df: DataFrame, *keep: str, document: Column) -> DataFrame:
    """P5. Every leaf of each row's JSON document: the kept columns, dotted path, kind and text.

    Kinds are string, int, float, bool and null; a string is its own text, any other value its JSON text. Empty
    objects and lists have no leaf, nor has a malformed or NULL document (a key named twice is malformed; what follows
    the document's end isn't looked at).
    Documents are parsed once and opened level by level, as many levels as the deepest one has; each level is
    checkpointed while the query is built, so none is opened again for the levels below it.
    """
    checkpoint_dir(df.sparkSession)
    df = dealt(df, task_count(df, rows=DOCUMENTS), *keep)
    rows = df.select(*keep, F.lit("").alias("path"), F.try_parse_json(document).alias("_v")).where("_v IS NOT NULL")
    levels = []
    while True:
        typed = rows.withColumn("_t", F.schema_of_variant("_v")).checkpoint()
        holds = F.col("_t").startswith("OBJECT<") | F.col("_t").startswith("ARRAY<")
        kind = (
            F.when(F.col("_t") == "STRING", "string")
            .when(F.col("_t") == "BOOLEAN", "bool")
            .when(F.col("_t") == "VOID", "null")
            .when(F.col("_t").rlike(r"^BIGINT$|^DECIMAL\(\d+,0\)$"), "int")
            .otherwise("float")
        )
        value = F.when(kind == "string", F.try_variant_get("_v", "$", "string")).otherwise(F.to_json("_v"))
        levels.append(typed.where(~holds).select(*keep, "path", kind.alias("kind"), value.alias("value")))
        inner = typed.where(holds)
        if inner.isEmpty():
            return reduce(DataFrame.unionByName, levels)
        name = F.coalesce("key", F.col("pos").cast("string"))
        path = F.when(F.col("path") == "", name).otherwise(F.concat("path", F.lit("."), name))
        opened = inner.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_v").outer()))
        rows = opened.select(*keep, path.alias("path"), F.col("value").alias("_v"))
