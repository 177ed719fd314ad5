"""One table from files whose records change their fields.

Each file's schema is the set of its records' (key, JSON type); its hash is the
file's fingerprint. A fingerprint is compiled once into explicit steps

    rename   the key that a target field has here
    cast     how its JSON type becomes the target type
    default  how a target field is filled where the key or the value is missing

and every file is routed through the steps of its fingerprint. Consecutive
files of a series get a new schema version whenever the fingerprint changes, and
`changes` reports what changed.

Bodies that are null, empty, cut off or without records hold no schema and no
rows; series skip them. Records that aren't objects are ignored. A key with
only nulls is a field of no type. If two keys of a file mean one field, the one
first in the list of names is taken and the other reported under its own name.
Keys are compared by their letters and digits only, without case.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions import whole_json

RECORD = "map<string,variant>"
CHUNK = 256


@dataclass(frozen=True)
class Field:
    """A target field: kind is text, number or date; names are the keys it may have, defaults the
    rules, by name and in order, that fill it where key or value is missing."""

    name: str
    kind: str
    names: tuple[str, ...]
    defaults: tuple[str, ...] = ()


def records(wrap: Column, body: Column, path: str) -> Column:
    """The objects of the array at `path` of a whole document, as maps of variants; null if there is none."""
    parsed = whole_json.member(wrap, body, path, "array<variant>")
    as_maps = F.transform(parsed, lambda r: F.try_variant_get(r, "$", RECORD))
    return F.filter(as_maps, lambda r: r.isNotNull())


# The types that JSON values have as variants.
_TYPES = {"STRING": "string", "BOOLEAN": "boolean", "OBJECT": "object", "ARRAY": "array", "BIGINT": "number", "DOUBLE": "number", "DECIMAL": "number", "FLOAT": "number"}


def json_type(v: Column) -> Column:
    """string, number, boolean, object or array; null for null."""
    names = F.create_map(*[F.lit(x) for pair in _TYPES.items() for x in pair])
    return F.try_element_at(names, F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0))


def seen_keys(recs: Column) -> Column:
    """The distinct struct(key, type) of the records, in no order."""
    return F.array_distinct(F.flatten(F.transform(recs, lambda r: F.transform(F.map_entries(r), lambda e: F.struct(e["key"].alias("key"), json_type(e["value"]).alias("type"))))))


def fields_of(seen: Column) -> Column:
    """Sorted array of struct(key, type): each key once; its type that of its non-null values."""
    typed = F.filter(seen, lambda x: x["type"].isNotNull())
    only_null = F.filter(seen, lambda x: x["type"].isNull() & ~F.exists(typed, lambda t: t["key"] == x["key"]))
    return F.array_sort(F.concat(typed, only_null))


def squeezed(key: Column) -> Column:
    return F.lower(F.regexp_replace(key, "[^A-Za-z0-9]", ""))


def _tagged(fields: Column, targets: Sequence[Field]) -> Column:
    """The fields with what each key may stand for: t (target, and its place among the target's names), or null."""
    known = {n: (t.name, i) for t in reversed(targets) for i, n in enumerate(squeezed_names(t))}
    lookup = F.create_map(*[x for n, (target, i) in known.items() for x in (F.lit(n), F.struct(F.lit(target).alias("target"), F.lit(i).alias("place")))])
    def tag(x: Column) -> Column:
        t = F.try_element_at(lookup, squeezed(x["key"]))
        return F.struct(x["key"].alias("key"), x["type"].alias("type"), t["target"].alias("target"), F.struct(x["key"] != t["target"], t["place"], x["key"]).alias("rank"))
    return F.transform(fields, tag)


def steps(tagged: Column) -> Column:
    """array of struct(field, key, type): the rename and cast rule of each field in a fingerprint.

    Targets come under their own names, all other keys under theirs. Of two keys for one target the target's own
    name is taken, else the first in the list of its names. tagged should be a column, as each of its elements is looked at for each.
    """
    def rule(x: Column) -> Column:
        beaten = F.exists(tagged, lambda y: F.coalesce((y["target"] == x["target"]) & (y["rank"] < x["rank"]), F.lit(False)))
        return F.struct(F.when(x["target"].isNotNull() & ~beaten, x["target"]).otherwise(x["key"]).alias("field"), x["key"].alias("key"), x["type"].alias("type"))
    return F.transform(tagged, rule)


def squeezed_names(t: Field) -> list[str]:
    """The keys of a field as they are compared, in order of preference."""
    return list(dict.fromkeys("".join(c for c in n.lower() if c.isascii() and c.isalnum()) for n in (t.name, *t.names)))


def fingerprints(files: DataFrame, keep: Sequence[str], body: str, path: str) -> DataFrame:
    """keep, recs, fields and fingerprint of each file; without records fields is empty or null.

    Filter on fields only after writing or exploding: a filter is pushed down
    and would parse every body twice.
    """
    out = files.select(*keep, body, whole_json.wrapped(F.col(body)).alias("_doc"))
    out = out.select(*keep, records(F.col("_doc"), F.col(body), path).alias("recs")).select("*", seen_keys(F.col("recs")).alias("_seen"))
    out = out.select(*keep, "recs", fields_of(F.col("_seen")).alias("fields"))
    return out.withColumn("fingerprint", F.xxhash64("fields"))


def registry(schemas: DataFrame, targets: Sequence[Field], kept: DataFrame | None = None) -> DataFrame:
    """fingerprint, steps (rename and cast), defaults (field, rules of each target): every distinct fingerprint, compiled once.

    kept is the registry of earlier loads: its fingerprints keep their steps, only new ones are compiled.
    Fingerprints are few bytes and costly to compile, so they are dealt out over all tasks.
    """
    if kept is not None:
        return kept.unionByName(registry(schemas.join(kept.select("fingerprint"), "fingerprint", "left_anti"), targets))
    tasks = int(schemas.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = schemas.where(F.size("fields") > 0).select("fingerprint", "fields").groupBy("fingerprint").agg(F.min("fields").alias("fields"))
    known = known.repartition(tasks, F.xxhash64("fingerprint")).select("fingerprint", _tagged(F.col("fields"), targets).alias("_tagged"))
    known = known.select("fingerprint", steps(F.col("_tagged")).alias("steps"))
    rules = F.array(*[F.struct(F.lit(t.name).alias("field"), F.array(*map(F.lit, t.defaults)).cast("array<string>").alias("rules")) for t in targets])
    return known.withColumn("defaults", rules)


def previous(df: DataFrame, series: str, position: str, carry: Sequence[str]) -> DataFrame:
    """df with prev_<c>: the values of the row before in its series, by position.

    A series may hold a third of all rows, so no task sorts a whole one: rows are
    windowed in chunks of positions, and only the last row of each chunk
    is handed on to the next one.
    """
    row = F.struct(*carry)
    df = df.withColumn("_chunk", F.floor(F.col(position) / CHUNK))
    inside = Window.partitionBy(series, "_chunk").orderBy(position)
    df = df.withColumn("_prev", F.lag(row).over(inside))
    ends = df.groupBy(series, "_chunk").agg(F.max_by(row, position).alias("_end"))
    handed = ends.withColumn("_carried", F.lag("_end").over(Window.partitionBy(series).orderBy("_chunk"))).where("_carried is not null").select(series, "_chunk", "_carried")
    out = df.join(handed, [series, "_chunk"], "left").withColumn("_prev", F.coalesce("_prev", "_carried"))
    return out.select(*[c for c in df.columns if c not in ("_chunk", "_prev")], *[F.col(f"_prev.{c}").alias(f"prev_{c}") for c in carry])


def changes(schemas: DataFrame, known: DataFrame, file_id: str, series: str, position: str) -> DataFrame:
    """file_id, field, change (added, removed, renamed, retyped), with the keys and types before and after.

    schemas holds the files with records, known their registry. Each distinct step from one fingerprint
    to another is worked out once, then given to the files that took it; files that
    changed nothing, the bulk of them, take part in no join.
    """
    both = previous(schemas.select(file_id, series, position, "fingerprint"), series, position, ["fingerprint"])
    both = both.where(F.col("prev_fingerprint").isNotNull() & (F.col("prev_fingerprint") != F.col("fingerprint"))).select(file_id, "fingerprint", "prev_fingerprint")
    moves = both.select("fingerprint", "prev_fingerprint").distinct()
    moves = moves.join(known, "fingerprint").join(known.select(F.col("fingerprint").alias("prev_fingerprint"), F.col("steps").alias("prev_steps")), "prev_fingerprint")
    def side(c: str, s: int) -> DataFrame:
        return moves.select("fingerprint", "prev_fingerprint", F.inline(c).alias("field", "key", "type"), F.lit(s).alias("s"))
    def of(c: str, s: int, name: str) -> Column:
        return F.max(F.when(F.col("s") == s, F.col(c))).alias(name)
    met = side("steps", 1).unionByName(side("prev_steps", 0)).groupBy("fingerprint", "prev_fingerprint", "field").agg(
        of("key", 1, "key"), of("key", 0, "prev_key"), of("type", 1, "type"), of("type", 0, "prev_type")
    )
    kinds = F.array(
        F.when(F.col("prev_key").isNull(), "added"),
        F.when(F.col("key").isNull(), "removed"),
        F.when(F.col("key") != F.col("prev_key"), "renamed"),
        F.when(F.col("key").isNotNull() & F.col("prev_key").isNotNull() & (F.col("type") != F.col("prev_type")), "retyped"),
    )
    met = met.withColumn("change", F.explode(F.array_compact(kinds)))
    return both.join(met, ["fingerprint", "prev_fingerprint"]).select(file_id, "field", "change", "key", "prev_key", "type", "prev_type")


def suggested_names(found: DataFrame, targets: Sequence[Field]) -> DataFrame:
    """field, key, files: keys without a field that came with the values' type in files in which a target went missing, by how many
    files; the next names to add to that field. found is what `changes` gives. Nothing is renamed by it."""
    names = [t.name for t in targets]
    gone = found.where((F.col("change") == "removed") & F.col("field").isin(names)).select("file_id", "field", F.col("prev_type").alias("type"))
    came = found.where((F.col("change") == "added") & ~F.col("field").isin(names)).select("file_id", "key", "type")
    return gone.join(came, ["file_id", "type"]).groupBy("field", "key").agg(F.count_distinct("file_id").alias("files"))


def versions(schemas: DataFrame, file_id: str, series: str, position: str) -> DataFrame:
    """file_id, fingerprint, schema_version: 1 for a series' first file, one more at each change."""
    both = previous(schemas.select(file_id, series, position, "fingerprint"), series, position, ["fingerprint"])
    both = both.withColumn("_new", F.when(F.col("prev_fingerprint").eqNullSafe(F.col("fingerprint")), 0).otherwise(1)).withColumn("_chunk", F.floor(F.col(position) / CHUNK))
    inside = F.sum("_new").over(Window.partitionBy(series, "_chunk").orderBy(position))
    before = both.groupBy(series, "_chunk").agg(F.sum("_new").alias("_k")).withColumn(
        "_before", F.coalesce(F.sum("_k").over(Window.partitionBy(series).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    return both.withColumn("_in", inside).join(before.select(series, "_chunk", "_before"), [series, "_chunk"]).select(file_id, series, position, "fingerprint", (F.col("_in") + F.col("_before")).alias("schema_version"))


def _plain(v: Column, inner: str) -> Column:
    """The text of a variant; of an object, that of its member `inner`."""
    return F.coalesce(F.try_variant_get(v, f"$.{inner}", "string"), F.when(json_type(v).isin("string", "number", "boolean"), F.try_variant_get(v, "$", "string")))


def cast(v: Column, kind: str) -> Column:
    """The cast rule of a target kind, for every JSON type; null where it doesn't apply."""
    if kind == "text":
        t = F.trim(_plain(v, "name"))
        return F.when(t != "", t)
    t = F.trim(_plain(v, "amount"))
    if kind == "number":
        return F.regexp_replace(t, "[,%$ ]", "").try_cast("double")
    if kind != "date":
        raise ValueError(kind)
    return F.coalesce(
        F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(t, 1, 10).try_cast("date")),
        F.when(t.rlike(r"^\d{8}$"), F.try_to_date(t, "yyyyMMdd")),
        F.when(t.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(t, "M/d/yyyy")),
    )


def route(schemas: DataFrame, known: DataFrame, keep: Sequence[str], targets: Sequence[Field]) -> DataFrame:
    """One row per record: keep, _at (its place in the file) and the target fields, renamed and cast by its file's steps.

    known is the registry; most files share a few fingerprints, so it is
    broadcast where a count shows it to be small.
    """
    keys = known.select("fingerprint", F.map_from_entries(F.transform("steps", lambda s: F.struct(s["field"].alias("k"), s["key"].alias("v")))).alias("_keys"))
    small = keys.limit(50_001).count() <= 50_000
    rows = schemas.join(F.broadcast(keys) if small else keys, "fingerprint").select(*keep, "_keys", F.posexplode("recs").alias("_at", "_rec"))
    return rows.select(*keep, "_at", *[cast(F.try_element_at("_rec", F.try_element_at("_keys", F.lit(t.name))), t.kind).alias(t.name) for t in targets])


def fill(rows: DataFrame, targets: Sequence[Field], rules: Mapping[str, Column]) -> DataFrame:
    """rows with the default rules of each target applied; all rules see the values as they were routed."""
    return rows.withColumns({t.name: F.coalesce(t.name, *[rules[r] for r in t.defaults]) for t in targets if t.defaults})
