"""Quality jobs: structure, schema, physics, governance, conformance, and their roll-up.

A finding is a row (level, check, severity, message, take). Each level is one job over all takes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import sets
from ..operators.blocks import dealt, running_steps, small, task_count
from ..operators.quantiles import exact_quantiles_of

FREE_AXES = ("T", "N")


def finding(level: str, check: str, severity: str | Column, message: Column | str, *keep: str) -> list[Column]:
    """The columns of a finding, after the kept ones."""
    text = F.lit(message) if isinstance(message, str) else message
    grade = F.lit(severity) if isinstance(severity, str) else severity
    return [*[F.col(c) for c in keep], F.lit(level).alias("level"), F.lit(check).alias("check"), grade.alias("severity"), text.alias("message")]


def failed_rules(df: DataFrame, rules: Mapping[str, Column], *, level: str, check: str, keep: Sequence[str], severity: str = "FAIL") -> DataFrame:
    """One finding per rule that a row breaks; rules are a name and the condition of the breach."""
    hits = F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules.items()]))
    broken = df.select(*keep, F.explode(hits).alias("_m"))
    return broken.select(*finding(level, check, severity, F.col("_m"), *keep))


# -- capabilities and expected files ---------------------------------------------------------


def capabilities(takes: DataFrame, profiles: DataFrame, *, source: str, mode: str, by_mode: Mapping[str, Sequence[str]], known: Sequence[str]) -> DataFrame:
    """P3. Capabilities from the mode and from the source's profile, of the known ones.

    ``by_mode`` lists every known mode; another one keeps the declared part only and is marked.
    """
    names = lambda values: F.array(*[F.lit(v) for v in values]).cast("array<string>")
    derived = F
    for m, caps in by_mode.items():
        derived = derived.when(F.col(mode) == m, names(caps))
    joined = takes.join(small(profiles.select(source, F.col("capabilities").alias("_declared"))), source, "left")
    declared = F.coalesce("_declared", names([]))
    both = F.array_union(F.coalesce(derived.otherwise(None), names([])), declared)
    return joined.withColumns(
        {"capabilities": F.array_sort(F.array_intersect(both, names(known))), "unknown_mode": ~F.col(mode).isin(*by_mode)}
    ).drop("_declared")


def expected_files(takes: DataFrame, artifacts: Mapping[str, str | None], *, keys: Sequence[str]) -> DataFrame:
    """P4. The files a take owes: those without a condition and those of its capabilities."""
    cells = [F.struct(F.lit(f).alias("file"), F.lit(c).cast("string").alias("needs")) for f, c in artifacts.items()]
    rows = takes.select(*keys, "capabilities", F.inline(F.array(*cells)))
    return rows.where(F.col("needs").isNull() | F.array_contains("capabilities", F.col("needs"))).select(*keys, "file")


# -- level 0 ---------------------------------------------------------------------------------


def root_findings(datasets: DataFrame, files: DataFrame, *, dataset: str, name: str, index: str, description: str) -> DataFrame:
    """Q1. Datasets whose root lacks the index or, where there is one, any file whose name matches the pattern ``description``.

    ``files`` has one row per file of a root. Without an index nothing else of a dataset is looked at (``indexed`` keeps the others).
    """
    seen = files.groupBy(dataset).agg(F.bool_or(F.col(name) == index).alias("_index"), F.bool_or(F.col(name).rlike(description)).alias("_text"))
    has = lambda c: F.coalesce(F.col(c), F.lit(False))
    joined = datasets.select(dataset).distinct().join(seen, dataset, "left")
    rules = {f"missing {index}": ~has("_index"), "missing description": has("_index") & ~has("_text")}
    return failed_rules(joined, rules, level="L0", check="structure", keep=[dataset])


def indexed(rows: DataFrame, files: DataFrame, *, dataset: str, name: str, index: str) -> DataFrame:
    """Q1. Rows of the datasets that have an index, the only ones whose takes are looked at."""
    return rows.join(files.where(F.col(name) == index).select(dataset).distinct(), dataset, "left_semi")


def structure_findings(
    index: DataFrame, stored: DataFrame, files: DataFrame, artifacts: Mapping[str, str | None], *, take: str, sized_by: DataFrame | None = None
) -> DataFrame:
    """Q1. Takes without storage, files an ok take lacks, and stored takes the index does not name.

    ``index`` has status and capabilities; ``files`` has one row per stored file. ``sized_by`` saves counting
    ``files``: a table with about as many rows at least.
    """
    tasks = max(task_count(files if sized_by is None else sized_by), task_count(index, per_row=len(artifacts)))
    index, stored, files = dealt(index, tasks, take), dealt(stored, tasks, take), dealt(files, tasks, take, "file")
    ok = index.where("status = 'ok'")
    lost = ok.join(stored, take, "left_anti").select(*finding("L0", "structure", "FAIL", "missing take dir", take))
    owed = dealt(expected_files(ok.join(stored, take, "left_semi"), artifacts, keys=[take]), tasks, take, "file")
    absent = owed.join(files, [take, "file"], "left_anti")
    absent = absent.select(*finding("L0", "structure", "FAIL", F.concat(F.lit("missing deliverable "), "file"), take))
    orphan = stored.join(index, take, "left_anti").select(*finding("L0", "structure", "FAIL", "orphan take dir", take))
    return lost.unionByName(absent).unionByName(orphan)


def count_findings(entries: DataFrame, stated: DataFrame, *, dataset: str) -> DataFrame:
    """A7. Stated counts against the entries, and whether they add up."""
    real = entries.groupBy(dataset).agg(F.count_if(F.col("status") == "ok").alias("_ok"))
    joined = stated.join(real, dataset, "left")
    rules = {
        "ok count differs from ok entries": F.col("ok") != F.coalesce("_ok", F.lit(0)),
        "counts do not sum to total": F.col("ok") + F.col("failed") + F.col("excluded") != F.col("total"),
    }
    return failed_rules(joined, rules, level="L0", check="structure", keep=[dataset])


# -- level 1 ---------------------------------------------------------------------------------


def missing_fields(present: DataFrame, takes: DataFrame, fields: Sequence[str], waivers: DataFrame, *, take: str, source: str) -> DataFrame:
    """Q2. Core manifest fields a take lacks: a WARN when its source waives the field, else a FAIL.

    Expiry is not looked at here; an expired waiver fails in the conformance job.
    """
    cells = F.explode(F.array(*[F.lit(f) for f in fields])).alias("field")
    owed = takes.select(take, source, cells)
    gaps = owed.join(present.select(take, "field").distinct(), [take, "field"], "left_anti")
    excuse = waivers.select(source, F.col("target").alias("field"), F.lit(True).alias("_w")).distinct()
    graded = gaps.join(small(excuse), [source, "field"], "left").withColumn("_s", F.when(F.col("_w"), "WARN").otherwise("FAIL"))
    return graded.select(*finding("L1", "manifest", F.col("_s"), F.concat(F.lit("missing manifest field:"), "field"), take))


def declared_keys(takes: DataFrame, spec: DataFrame, *, take: str) -> DataFrame:
    """Every key the declaration names for a take's artifacts, with ``allowed`` by its capabilities.

    Takes meet the declaration folded to one row per artifact.
    """
    cell = F.struct("key", F.col("dtype").alias("_dtype"), "axes", F.col("capability").alias("_cap"))
    cells = small(spec.groupBy("artifact").agg(F.collect_set(cell).alias("_cells")))
    expanded = takes.select(take, "artifact", "capabilities").join(cells, "artifact").select(take, "artifact", "capabilities", F.inline("_cells"))
    allowed = F.col("_cap").isNull() | F.array_contains("capabilities", F.col("_cap"))
    return expanded.select(take, "artifact", "key", "_dtype", "axes", allowed.alias("_allowed"))


def array_spec_findings(observed: DataFrame, takes: DataFrame, spec: DataFrame, *, take: str) -> DataFrame:
    """Q3. Arrays against their declaration.

    ``observed``: take, artifact, key, shape, dtype. ``takes``: take, artifact, capabilities.
    ``spec``: artifact, key, dtype, axes, capability; an axis is a size or a free letter.
    """
    declared = declared_keys(takes, spec, take=take)
    on = [take, "artifact", "key"]
    missing = declared.where("_allowed").join(observed, on, "left_anti")
    missing = missing.select(*finding("L1", "schema", "FAIL", F.concat(F.lit("missing-key:"), "key"), take))
    seen = observed.join(declared, on, "left")
    fits_rank = F.size("shape") == F.size("axes")
    sizes = F.zip_with("axes", "shape", lambda a, s: ~a.isin(*FREE_AXES) & (a != s.cast("string")))
    told = F.col("_allowed")
    name = lambda text: F.concat(F.lit(text), "key")
    hits = F.array_compact(
        F.array(
            F.when(told.isNull(), name("unexpected-key:")),
            F.when(~told, name("forbidden-key:")),
            F.when(told & (F.col("dtype") != F.col("_dtype")), name("dtype-mismatch:")),
            F.when(told & ~fits_rank, name("rank-mismatch:")),
            F.when(told & fits_rank & F.exists(sizes, lambda bad: bad), name("axis-size-mismatch:")),
        )
    )
    wrong = seen.select(take, F.explode(hits).alias("_m")).select(*finding("L1", "schema", "FAIL", F.col("_m"), take))
    length = F.element_at("shape", F.array_position("axes", "T").cast("int"))
    free = seen.where(told & fits_rank & F.array_contains("axes", "T")).groupBy(take, "artifact").agg(
        F.min(length).alias("_a"), F.max(length).alias("_b")
    )
    uneven = free.where("_a <> _b").select(*finding("L1", "schema", "FAIL", F.concat(F.lit("free-axis-T-inconsistent:"), "artifact"), take))
    return missing.unionByName(wrong).unionByName(uneven)


def frame_count_findings(lengths: DataFrame, *, take: str, frames: str) -> DataFrame:
    """A6. Artifacts of one take with different frame counts."""
    spread = lengths.groupBy(take).agg(F.min(frames).alias("_a"), F.max(frames).alias("_b")).where("_a <> _b")
    return spread.select(*finding("L1", "schema", "FAIL", "frame counts differ across artifacts", take))


def declared_length_findings(df: DataFrame, *, take: str, values: Column, declared: Column) -> DataFrame:
    """A6. Arrays whose length is not the declared number."""
    return df.where(F.size(values) != declared).select(*finding("L1", "schema", "FAIL", "declared length differs", take))


def pair_id_findings(artifacts: DataFrame, *, take: str, pair: str) -> DataFrame:
    """Q16. More than one pair id in a take."""
    spread = artifacts.groupBy(take).agg(F.min(pair).alias("_a"), F.max(pair).alias("_b"))
    return spread.where(~F.col("_a").eqNullSafe(F.col("_b"))).select(*finding("L1", "pair", "FAIL", "pair ids differ", take))


# -- level 2 ---------------------------------------------------------------------------------


def contact_invariants(df: DataFrame, *, keys: Sequence[str], contact: Column, force: Column, point: Column, valid: Column, source_valid: Column) -> DataFrame:
    """A5. Breaches per group: force without contact, a point missing with or present without contact,
    and rows valid where their source is not."""
    return df.groupBy(*keys).agg(
        F.count_if(~contact & (force != 0)).alias("force_without_contact"),
        F.count_if(contact & point.isNull()).alias("point_missing"),
        F.count_if(~contact & point.isNotNull()).alias("point_without_contact"),
        F.count_if(valid & ~source_valid).alias("valid_beyond_source"),
        (F.count_if(valid) == 0).alias("nothing_valid"),
    )


def names_follow(all_names: Column, part: Column) -> Column:
    """A5. The partial name list is the whole one without its first entry."""
    return F.slice(all_names, F.lit(2), F.size(all_names) - 1).eqNullSafe(part)


def masked_confidence(valid: Column, value: Column) -> Column:
    """P17. The site's confidence where valid, 0 elsewhere."""
    return F.when(valid, value).otherwise(F.lit(0.0))


def confidence_findings(df: DataFrame, *, take: str, valid: Column, confidence: Column) -> DataFrame:
    """P17. Confidence under an invalid mask, or outside (0, 1] under a valid one."""
    counts = df.groupBy(take).agg(
        F.count_if(~valid & (confidence != 0)).alias("_under"),
        F.count_if(valid & ((confidence <= 0) | (confidence > 1) | confidence.isNull())).alias("_band"),
    )
    rules = {"confidence on invalid rows": F.col("_under") > 0, "confidence outside (0, 1]": F.col("_band") > 0}
    return failed_rules(counts, rules, level="L2", check="physical", keep=[take])


def physical_findings(df: DataFrame, *, take: str, site: str, frame: str, time: str, columns: Mapping[str, Column], bands: Mapping[str, float]) -> DataFrame:
    """Q4. One row per take, site and frame: mask discipline, confidence, norm, magnitude and rate bands, contact, coverage and the time axis.

    ``columns`` names what a row holds: valid, norm (of the orientation), magnitude (gravity included), rate,
    confidence, contact, force and point (of application; null is none). A band is judged over the valid rows
    of a take, and only where none of them lacks the value. Where a band is broken the finding names the
    worst site, the first by name among equals; a site without a valid row is a finding of its own.
    The frames are aggregated once, to a row per take and site.
    """
    held = df.select(take, site, frame, time, *[c.alias(n) for n, c in columns.items()])
    step = lambda before, here: here - before
    held = running_steps(held, keys=[take, site], frame=frame, value=F.col(time), step=step, out="step", total="_sum").drop("_sum")
    valid, confidence, contact = F.col("valid"), F.col("confidence"), F.col("contact")
    held = held.withColumn("_magnitude", F.when(valid, F.col("magnitude")))
    arrays = ("norm", "magnitude", "rate")
    counted = {
        **{f"{a}_lacking": F.count_if(valid & F.col(a).isNull()) for a in arrays},
        **{f"{a}_beyond": F.count_if(~valid & F.col(a).isNotNull()) for a in arrays},
        "confidence_lacking": F.count_if(confidence.isNull()),
        "confidence_under": F.count_if(~valid & (confidence != 0)),
        "confidence_band": F.count_if(valid & ((confidence <= 0) | (confidence > 1))),
        "force_without_contact": F.count_if(~contact & (F.col("force") != 0)),
        "point_missing": F.count_if(contact & F.col("point").isNull()),
        "point_without_contact": F.count_if(~contact & F.col("point").isNotNull()),
        "time_lacking": F.count_if(F.col(time).isNull()),
        "backward": F.count_if(F.col("step") <= 0),
        "rows": F.count(F.lit(1)),
        "usable": F.count_if(valid),
    }
    extremes = {"norm_off": F.max(F.when(valid, F.abs(F.col("norm") - 1.0))), "rate_max": F.max(F.when(valid, F.abs(F.col("rate"))))}
    sites = exact_quantiles_of(
        held, keys=[take, site], probs={"_magnitude": {"median": 0.5, "p95": 0.95}, "step": {"step_median": 0.5}},
        aggs=[c.alias(n) for n, c in {**counted, **extremes}.items()], sized_by=df,
    )
    low = (F.col("median") < bands["median_min"]) & (F.col("p95") < bands["floor_p95"])
    worst = lambda value: F.min_by(site, F.when(value.isNotNull(), F.struct(-value, F.col(site))))
    takes = sites.groupBy(take).agg(
        *[F.sum(n).alias(n) for n in counted],
        *[F.max(n).alias(n) for n in (*extremes, "median")],
        *[worst(F.col(n)).alias(f"{n}_site") for n in (*extremes, "median")],
        worst(F.when(low, -F.col("p95"))).alias("low_site"),
        F.max(F.abs(F.col("step_median") - bands["step_s"])).alias("step_off"),
        F.sort_array(F.collect_list(F.when(F.col("usable") == 0, F.col(site)))).alias("unseen"),
    )
    whole = {a: F.col(f"{a}_lacking") == 0 for a in (*arrays, "confidence", "time")}
    at = lambda text, n: F.concat(F.lit(f"{text} at "), F.col(n).cast("string"))
    some = lambda n: F.col(n) > 0
    rules = [
        *[(F.lit(f"{a} missing on valid rows"), some(f"{a}_lacking")) for a in arrays],
        *[(F.lit(f"{a} present on invalid rows"), some(f"{a}_beyond")) for a in arrays],
        (F.lit("confidence missing"), some("confidence_lacking")),
        (F.lit("confidence on invalid rows"), whole["confidence"] & some("confidence_under")),
        (F.lit("confidence outside (0, 1]"), whole["confidence"] & some("confidence_band")),
        (at("norm off", "norm_off_site"), whole["norm"] & (F.col("norm_off") > bands["norm_off"])),
        (at("magnitude too high", "median_site"), whole["magnitude"] & (F.col("median") > bands["median_max"])),
        (at("gravity missing", "low_site"), whole["magnitude"] & F.col("low_site").isNotNull()),
        (at("rate too high", "rate_max_site"), whole["rate"] & (F.col("rate_max") > bands["rate_max"])),
        (F.lit("force without contact"), some("force_without_contact")),
        (F.lit("point missing in contact"), some("point_missing")),
        (F.lit("point without contact"), some("point_without_contact")),
        (F.lit("time missing"), some("time_lacking")),
        (F.lit("times not increasing"), whole["time"] & some("backward")),
        (F.lit("time step off"), whole["time"] & (F.col("step_off") > bands["step_tolerance_s"])),
        (F.lit("coverage too low"), F.col("usable") < bands["min_coverage"] * F.col("rows")),
    ]
    hits = F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(False)), text) for text, broken in rules]))
    unseen = F.transform("unseen", lambda s: F.concat(F.lit("no valid row at "), s.cast("string")))
    broken = takes.select(take, F.explode(F.concat(hits, unseen)).alias("_m"))
    return broken.select(*finding("L2", "physical", "FAIL", F.col("_m"), take))


# -- level 4 ---------------------------------------------------------------------------------


def governance_rules(spec_id: str, spec_version: str, scope: str) -> dict[str, Column]:
    """P6. Lineage rules on the extracted manifest columns, as breach conditions."""
    version = F.col("spec_version")
    return {
        "missing distribution_scope": F.col("distribution_scope").isNull(),
        "wrong distribution_scope": F.col("distribution_scope") != scope,
        "wrong spec_id": F.col("spec_id") != spec_id,
        "wrong spec_version": version != spec_version,
        "bare version number": version.rlike(X.BARE_VERSION),
        "banned token in lineage": F.coalesce(version.rlike(X.BANNED_TOKEN), F.lit(False)) | F.coalesce(F.col("spec_id").rlike(X.BANNED_TOKEN), F.lit(False)),
        "missing contract id": F.coalesce(F.col("contract_id"), F.lit("")) == "",
    }


def absolute_paths(leaves: DataFrame, *, keep: Sequence[str]) -> DataFrame:
    """P5. String leaves that hold an absolute path."""
    hits = leaves.where((F.col("kind") == "string") & F.col("value").rlike(X.ABSOLUTE_PATH))
    return hits.select(*finding("L4", "governance", "FAIL", F.concat(F.lit("absolute path at "), "path"), *keep))


def stated_field_rules(required: Mapping[str, str], optional: Mapping[str, str]) -> dict[str, Column]:
    """Q6. Fields that must be there with one value, and fields that may be absent but hold no other value."""
    absent = {f"missing {name}": F.col(name).isNull() for name in required}
    return absent | {f"wrong {name}": F.col(name) != value for name, value in {**required, **optional}.items()}


def governance_findings(
    manifests: DataFrame, leaves: DataFrame, *, take: str, spec_id: str, spec_version: str, scope: str,
    required: Mapping[str, str] | None = None, optional: Mapping[str, str] | None = None,
) -> DataFrame:
    """Q6. Unreadable manifests, lineage breaches, other fields with a prescribed value and absolute paths."""
    level = {"level": "L4", "check": "governance", "keep": [take]}
    unreadable = failed_rules(manifests, {"unreadable manifest": ~F.col("readable")}, **level)
    lineage = failed_rules(manifests.where("readable"), governance_rules(spec_id, spec_version, scope) | stated_field_rules(required or {}, optional or {}), **level)
    return sets.all_findings(unreadable, lineage, absolute_paths(leaves, keep=[take]))


def conformance_findings(
    observed: DataFrame, allowed: DataFrame, waivers: DataFrame, required: DataFrame, files: DataFrame, *, source: str, today: Column, pending: Sequence[str]
) -> DataFrame:
    """Q7. Undeclared keys, expired waivers (FAIL), missing bundle files (FAIL, WARN for those only
    distribution needs) that are neither waived nor still pending."""
    waived = waivers.select(source, F.col("target").alias("name"))
    unknown = sets.undeclared(observed, allowed.select(source, "name"), waived, on=[source, "name"])
    unknown = unknown.select(*finding("L1", "conformance", "FAIL", F.concat(F.lit("undeclared key "), "name"), source))
    expired = waivers.where(F.col("expires") < today)
    expired = expired.select(*finding("L4", "conformance", "FAIL", F.concat(F.lit("expired waiver "), "target"), source))
    gaps = required.join(files.select(source, "name"), [source, "name"], "left_anti").join(waived, [source, "name"], "left_anti")
    gaps = gaps.where(~F.col("name").isin(*pending)) if pending else gaps
    grade = F.when(F.col("distribution"), "WARN").otherwise("FAIL")
    gaps = gaps.select(*finding("L0", "conformance", grade, F.concat(F.lit("missing file "), "name"), source))
    return sets.all_findings(unknown, expired, gaps)


def limitation_problems(entries: DataFrame, *, id_: str, kinds: Sequence[str], severities: Sequence[str], statuses: Sequence[str], levels: Sequence[str]) -> DataFrame:
    """Q11. Ways in which an entry's extracted columns break its schema; ``entry_problems`` reads whole entries."""
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    outside = lambda c, values: ~F.coalesce(F.col(c).isin(*values), F.lit(False))
    rules = {
        "missing statement": blank("statement"),
        "unknown kind": outside("kind", kinds),
        "unknown severity": outside("severity", severities),
        "unknown status": outside("status", statuses),
        "fixed without fixed_in": (F.col("status") == "fixed") & blank("fixed_in"),
        "mitigated without mitigation": (F.col("status") == "mitigated") & blank("mitigation"),
        "since is not a date": F.expr("try_to_date(since, 'yyyy-MM-dd') is null"),
        "unknown scope level": outside("level", levels),
    }
    hits = F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules.items()]))
    return entries.select(id_, F.explode(hits).alias("problem"))


#: Limitation entries that one task checks.
ENTRIES = 20_000


def entry_problems(
    entries: DataFrame, *, file: str, position: str, entry: str, required: Sequence[str], optional: Sequence[str], scope_lists: Mapping[str, str | None],
    kinds: Sequence[str], severities: Sequence[str], statuses: Sequence[str], levels: Sequence[str],
) -> DataFrame:
    """Q11. Every way in which limitation entries, given as JSON text by file and position, break their schema.

    ``scope_lists`` names the scope's lists with the scope level that needs one filled. An entry that is no JSON object has that one
    problem. Of the entries of a file with one id (or without), all but the first are duplicates.
    """
    value = lambda path: F.get_json_object(entry, f"$.{path}")
    blank = lambda path: F.trim(F.coalesce(value(path), F.lit(""))) == ""
    outside = lambda path, values: ~F.coalesce(value(path).isin(*values), F.lit(False))
    listed = lambda path: F.try_variant_get("_v", f"$.{path}", "array<variant>")
    fields = lambda path: F.map_keys(F.try_variant_get("_v", path, "map<string,variant>"))
    strange = lambda c, known: F.array_sort(F.array_except(c, F.array(*[F.lit(k) for k in known])))
    no_list = lambda path: value(path).isNotNull() & listed(path).isNull()
    rows = entries.select(file, position, entry, F.try_parse_json(entry).alias("_v"), F.concat(F.lit("id "), value("id")).alias("_id"))
    rows = rows.withColumns({"_fields": fields("$"), "_scope": fields("$.scope"), "_id": F.coalesce("_id", F.lit("none"))})
    rows = dealt(rows, task_count(entries, rows=ENTRIES), file, "_id")
    first = rows.where("_fields is not null").groupBy(file, "_id").agg(F.min(position).alias("_first"))
    rows = rows.join(first, [file, "_id"], "left")
    scoped = F.col("_scope").isNotNull()
    rules = {
        **{f"missing {name}": blank(name) for name in required if name != "scope"},
        "unknown kind": outside("kind", kinds),
        "unknown severity": outside("severity", severities),
        "unknown status": outside("status", statuses),
        "fixed without fixed_in": (value("status") == "fixed") & blank("fixed_in"),
        "mitigated without mitigation": (value("status") == "mitigated") & blank("mitigation"),
        "since is not a date": F.try_to_date(value("since"), "yyyy-MM-dd").isNull(),
        "scope is not an object": ~scoped,
        "unknown scope level": scoped & outside("scope.level", levels),
        **{f"scope.{name} is not a list": scoped & no_list(f"scope.{name}") for name in scope_lists},
        **{
            f"scope.{name} is empty": (value("scope.level") == level) & (F.coalesce(F.trim(value(f"scope.{name}")), F.lit("")).isin("", "[]"))
            for name, level in scope_lists.items() if level
        },
        "related is not a list": no_list("related"),
        "duplicate id": F.col(position) > F.col("_first"),
    }
    hits = F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules.items()]))
    named = lambda c, text: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda n: F.concat(F.lit(text), n))
    unknown = named(strange(F.col("_fields"), [*required, *optional]), "unknown field ")
    beyond = named(strange(F.col("_scope"), ["level", *scope_lists]), "unknown scope field ")
    none = F.array(F.lit("entry is not an object"))
    problems = F.when(F.col("_fields").isNull(), none).otherwise(F.concat(hits, unknown, beyond))
    return rows.select(file, position, F.explode(problems).alias("problem"))


# -- roll-up and small row rules ---------------------------------------------------------------


def roll_up_findings(findings: DataFrame) -> DataFrame:
    """A8, S16. Findings per level, the totals, and whether the run passes."""
    fails = F.count_if(F.col("severity") == "FAIL")
    return findings.rollup("level").agg(
        F.grouping("level").cast("bigint").alias("total_row"),
        fails.alias("fail"),
        F.count_if(F.col("severity") == "WARN").alias("warn"),
        (fails == 0).alias("passed"),
    )


def write_report(findings: DataFrame, path: str) -> None:
    """S16. The findings table and its summary."""
    findings.write.mode("overwrite").json(f"{path}/findings")
    roll_up_findings(findings).write.mode("overwrite").json(f"{path}/summary")


def rate_with_provenance(native: Column, alternative: Column, fallback: Column) -> tuple[Column, Column]:
    """P8. First usable rate and where it came from; both null when nothing is usable."""
    good = lambda c: c.isNotNull() & ~F.isnan(c) & (c > 0)
    value = F.when(good(native), native).when(good(alternative), alternative).when(good(fallback), fallback)
    label = F.when(good(native), "native").when(good(alternative), "alternative").when(good(fallback), "fallback")
    return value, label


def select_named(df: DataFrame, wanted: Sequence[str], *, name: str) -> tuple[DataFrame, DataFrame]:
    """P16. The named rows, and the names that do not exist. An empty selection is an error."""
    if not wanted:
        raise ValueError("nothing selected")
    asked = df.sparkSession.createDataFrame([(w,) for w in dict.fromkeys(wanted)], f"{name} string")
    return df.join(asked, name, "left_semi"), asked.join(df.select(name), name, "left_anti")


def require_known(unknown: DataFrame, *, name: str) -> None:
    """P16. Raise when a selection named something that does not exist."""
    first = unknown.orderBy(name).first()
    if first is not None:
        raise ValueError(f"unknown {name}: {first[0]}")


def cut_window(df: DataFrame, *, keys: Sequence[str], frame: str, time: str, start: int, stop: int) -> DataFrame:
    """P21. Rows ``[start, stop)`` of each take, with frames and clock from zero.

    Window columns are computed on the whole take before the cut. A take keeps at most
    ``stop - start`` rows, so the join on the take is even.
    """
    inside = df.where((F.col(frame) >= start) & (F.col(frame) < stop))
    firsts = inside.groupBy(*keys).agg(F.min(time).alias("_t0"))
    zeroed = {frame: F.col(frame) - start, time: F.col(time) - F.col("_t0")}
    return inside.join(firsts, list(keys)).withColumns(zeroed).drop("_t0")


def in_sample(df: DataFrame, patterns: Sequence[str], *, subject: str, take: str) -> DataFrame:
    """P11. Rows where a pattern of the (short, declared) list occurs in ``subject|take``."""
    text = F.concat_ws("|", subject, take)
    hit = F.lit(False)
    for p in patterns:
        hit = hit | F.contains(text, F.lit(p))
    return df.where(hit)


def without_glitches(df: DataFrame, *, glitch: Column, valid: str, channels: Sequence[str], confidence: str) -> DataFrame:
    """P18. Invalidate all channels, the mask and the confidence on glitch rows."""
    return df.withColumn("_g", F.coalesce(glitch, F.lit(False))).withColumns(
        {
            **{c: F.when(~F.col("_g"), F.col(c)) for c in channels},
            valid: F.col(valid) & ~F.col("_g"),
            confidence: F.when(F.col("_g"), F.lit(0.0)).otherwise(F.col(confidence)),
        }
    ).drop("_g")


def site_sources(sites: DataFrame, drivers: DataFrame, *, site: str) -> DataFrame:
    """P20. Whether a site is backed by its driving key, and the source label; ``drivers`` has one
    provenance per driven site, ``absent`` where nothing drives it."""
    joined = sites.join(small(drivers.select(F.col("site").alias(site), "provenance")), site, "left")
    backed = F.coalesce(F.col("provenance") != "absent", F.lit(False))
    return joined.withColumns({"backed": backed, "label": F.when(backed, F.col("provenance"))}).drop("provenance")


def effective_mask(valid: Column) -> Column:
    """P2. The stored mask, all true where there is none."""
    return F.coalesce(valid, F.lit(True))
