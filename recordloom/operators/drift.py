"""Schemas that drift between files: one consistent table and the list of changes.

Tagged-union inference: every record object of every file is taken apart into (key, value, JSON type); the parallel schemas are
fused by mapping each key to the field that it names; the types met under a field stay apart as tagged alternatives (one typed
branch each) beside one canonical text. The changes are read off by comparing each file with the one before it in its folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.session import cut

# The fields that are followed, the words that name each one, and words that may stand beside them.
FIELDS = ("model_version", "paper_title", "extension")
_HEADS = {"model_version": ("version", "ver", "versions", "vers"), "paper_title": ("title", "titles", "name"), "extension": ("extension", "extensions", "ext", "exts", "extends")}
_OWN = {"model_version": ("model", "llm", "lm"), "paper_title": ("paper", "source", "article", "publication", "doc", "document"), "extension": ("model", "with", "llm", "lm", "to", "of")}
TYPES = ("string", "number", "boolean", "array", "object")
RECORD_KEYS = ("extraction_data", "raw_extraction")


def key_words(key: Column) -> Column:
    """The lower-case words of a key, whatever its separators or case style."""
    spaced = F.regexp_replace(F.regexp_replace(key, r"([a-z0-9])([A-Z])", "$1 $2"), r"[^A-Za-z0-9]+", " ")
    return F.split(F.trim(F.lower(spaced)), " ")


def field_of(key: Column) -> Column:
    """The followed field that a key names, or NULL.

    A key names a field if one of its words is a head word of the field and all others are words that may stand beside it;
    a foreign qualifier (tokenizer version, short title, file extension) makes another field. A bare "name" names nothing.
    """
    words = key_words(key)
    out = F.lit(None).cast("string")
    for field in reversed(FIELDS):
        heads, own = F.array(*map(F.lit, _HEADS[field])), F.array(*map(F.lit, _OWN[field]))
        rest = F.array_except(words, heads)
        named = (F.size(rest) < F.size(F.array_distinct(words))) & (F.size(F.array_except(rest, own)) == 0)
        if field == "paper_title":  # "name" needs its qualifier
            named = named & (F.array_contains(words, "title") | F.array_contains(words, "titles") | (F.array_contains(words, "name") & (F.size(rest) > 0)))
        out = F.when(named, F.lit(field)).otherwise(out)
    return out


def json_type(schema: Column) -> Column:
    """string, number, boolean, array or object from what schema_of_variant says; NULL for null."""
    return (
        F.when(schema == "VOID", F.lit(None).cast("string"))
        .when(schema.startswith("ARRAY"), "array")
        .when(schema.startswith("OBJECT"), "object")
        .when(schema == "STRING", "string")
        .when(schema == "BOOLEAN", "boolean")
        .otherwise("number")
    )


def members(files: DataFrame) -> DataFrame:
    """(file_id, folder, written_at, pos, key, value VARIANT, field_name, json_type): the members of the record objects.

    Files delivered twice give their members twice, which changes nothing that is read off them here. A payload that is no JSON, or has no array of records, yields nothing; of the two layouts
    the first non-empty array counts. Array elements that are no object yield nothing.
    """
    doc = files.select("file_id", "folder", "written_at", "payload").where(F.col("payload").isNotNull()).withColumn("doc", F.try_parse_json("payload"))
    arrays = [F.try_variant_get("doc", f"$.{k}", "array<variant>") for k in RECORD_KEYS]
    pick = F.lit(None).cast("array<variant>")
    for a in reversed(arrays):
        pick = F.when(F.size(a) > 0, a).otherwise(pick)
    records = doc.select("file_id", "folder", "written_at", F.posexplode(pick).alias("pos", "record"))
    objects = records.where(F.schema_of_variant("record").startswith("OBJECT"))
    pairs = objects.select("file_id", "folder", "written_at", "pos", F.explode(F.try_variant_get("record", "$", "map<string,variant>")).alias("key", "value"))
    return pairs.withColumn("field_name", field_of(F.col("key"))).withColumn("json_type", json_type(F.coalesce(F.schema_of_variant("value"), F.lit("VOID"))))


def path_of(key: Column, field: Column) -> Column:
    """The path under which a key's values are fused: the followed field, else the words of the key."""
    return F.coalesce(field, F.nullif(F.array_join(key_words(key), "_"), F.lit("")), key)


def unread(files: DataFrame) -> DataFrame:
    """(file_id, folder, reason): files that give no record, once each: no payload, no JSON, or no records in either layout."""
    doc = files.select("file_id", "folder", "payload").withColumn("doc", F.try_parse_json("payload"))
    n = sum((F.coalesce(F.greatest(F.size(F.try_variant_get("doc", f"$.{k}", "array<variant>")), F.lit(0)), F.lit(0)) for k in RECORD_KEYS), F.lit(0))
    reason = F.when(F.col("payload").isNull(), "no payload").when(F.col("doc").isNull(), "no JSON").when(n == 0, "no records")
    return doc.select("file_id", "folder", reason.alias("reason")).where("reason is not null").dropDuplicates(["file_id"])  # no payload is moved


def alternatives(files: DataFrame) -> DataFrame:
    """(path, json_type, n_values, first_at): the types met under each path of all record objects, and when each first appeared.

    Values that are null have no type. Files delivered twice count once.
    """
    typed = members(files).where(F.col("json_type").isNotNull())
    m = typed.select("file_id", "written_at", "pos", "key", "field_name", "json_type").distinct()  # after the payloads are gone
    return m.groupBy(path_of(F.col("key"), F.col("field_name")).alias("path"), "json_type").agg(F.count("*").alias("n_values"), F.min("written_at").alias("first_at"))


def file_schemas(files: DataFrame) -> DataFrame:
    """One row for each file that has records: folder, written_at, file_id and, for each field, its key and JSON type in that file.

    A field with several keys in one file goes by the one that most records use (ties: smallest in byte order); its type is the
    most frequent one of its values that are not null (ties: in the order of TYPES).
    """
    m = members(files)
    by_key = m.groupBy("folder", "file_id", "written_at", "field_name", "key").agg(
        F.count("*").alias("n"), *[F.count(F.when(F.col("json_type") == t, 1)).alias(f"n_{t}") for t in TYPES]
    )
    per_file = by_key.groupBy("folder", "file_id", "written_at")
    outs = []
    for f in FIELDS:
        here = F.col("field_name") == f
        # most records first; of equal keys the smallest
        outs.append(F.min(F.when(here, F.struct((-F.col("n")).alias("n"), F.col("key").alias("key"))))["key"].alias(f"{f}_key"))
        counts = F.array(*[F.struct(F.sum(F.when(here, F.col(f"n_{t}"))).alias("n"), F.lit(-i).alias("i"), F.lit(t).alias("t")) for i, t in enumerate(TYPES)])
        best = F.array_max(counts)
        outs.append(F.when(best["n"] > 0, best["t"]).alias(f"{f}_type"))
    return per_file.agg(*outs)


def _last_states(cols: list[str], w) -> list[Column]:
    return [F.last(c, ignorenulls=True).over(w).alias(f"last_{c}") for c in cols]


def changes(files: DataFrame, bucket_seconds: int = 86_400) -> DataFrame:
    """(file_id, field_name, change_kind) for added, removed, renamed and retyped fields.

    Files of a folder are compared in the order of written_at, file_id; NULL folders make one folder of their own, a NULL
    written_at comes first. To keep a folder that holds a third of all files off one task, the files of a folder are compared
    inside buckets of time first; what each bucket starts from is carried over by a window over one row a bucket.
    """
    bucket = F.floor(F.coalesce(F.col("written_at").cast("timestamp").cast("long"), F.lit(0)) / bucket_seconds)
    s = cut(file_schemas(files)).withColumn("folder", F.coalesce("folder", F.lit(""))).withColumn("bucket", bucket)
    keys, types = [f"{f}_key" for f in FIELDS], [f"{f}_type" for f in FIELDS]
    order = F.struct(F.col("written_at"), F.col("file_id"))
    # what a bucket leaves behind: the keys of its last file, and the last known type of each field
    ends = s.groupBy("folder", "bucket").agg(
        F.max_by(F.struct(*keys), order).alias("end_keys"), *[F.max_by(t, F.when(F.col(t).isNotNull(), order)).alias(f"end_{t}") for t in types]
    )
    past = Window.partitionBy("folder").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("folder", "bucket", F.last("end_keys").over(past).alias("before_keys"), *[F.last(f"end_{t}", ignorenulls=True).over(past).alias(f"before_{t}") for t in types])
    w = Window.partitionBy("folder", "bucket").orderBy("written_at", "file_id")
    prior = w.rowsBetween(Window.unboundedPreceding, -1)
    inside = s.select("*", F.lag(F.struct(*keys)).over(w).alias("lag_keys"), *[F.last(t, ignorenulls=True).over(prior).alias(f"lag_{t}") for t in types])
    both = inside.join(carried, ["folder", "bucket"])
    prev = F.coalesce("lag_keys", "before_keys")
    found = []
    for f in FIELDS:
        now, was = F.col(f"{f}_key"), prev[f"{f}_key"]
        t, known = F.col(f"{f}_type"), F.coalesce(F.col(f"lag_{f}_type"), F.col(f"before_{f}_type"))
        one = lambda kind, cond, f=f: F.when(cond, F.struct(F.lit(f).alias("field_name"), F.lit(kind).alias("change_kind")))
        found += [
            one("added", was.isNull() & now.isNotNull()),
            one("removed", was.isNotNull() & now.isNull()),
            one("renamed", was.isNotNull() & now.isNotNull() & (was != now)),
            one("retyped", was.isNotNull() & now.isNotNull() & t.isNotNull() & known.isNotNull() & (t != known)),
        ]
    listed = both.where(prev.isNotNull()).select("file_id", F.explode(F.array_compact(F.array(*found))).alias("c"))
    return listed.select("file_id", "c.field_name", "c.change_kind")


def consistent(files: DataFrame) -> DataFrame:
    """One row for each record: file_id, folder, written_at, pos, model_name; for each followed field the key it had, the tag of its
    type, one typed branch for each alternative and one canonical text; and others, a map of every other path to its tag and text.

    The canonical text of an array is its elements joined by "; ", of an object its member "main", "value" or "text" or else its
    JSON, of a number its plain form, of a boolean true or false. A record without a field has NULL in all of its columns; a null
    is a path of others with NULL tag and text. Of several keys of one path in a record the one with a value counts, then the
    smallest. A record without any key gives no row; files that give none are listed by unread.
    """
    m = members(files)
    first = lambda cond, c: F.min_by(c, F.when(cond & F.col("value").isNotNull(), F.struct(F.col("json_type").isNull(), F.col("key"))))
    outs = [first(F.col("key") == "model_name", F.to_json("value")).alias("model_name_json")]
    for f in FIELDS:
        cond = F.col("field_name") == f
        outs += [first(cond, F.to_json("value")).alias(f"{f}_json"), first(cond, F.col("json_type")).alias(f"{f}_tag"), first(cond, F.col("key")).alias(f"{f}_key")]
    other = F.col("field_name").isNull() & (F.col("key") != "model_name")
    entry = F.struct(path_of(F.col("key"), F.col("field_name")).alias("path"), F.col("json_type").isNull().alias("empty"), "key", F.col("json_type").alias("tag"), F.when(F.col("json_type").isNotNull(), F.to_json("value")).alias("json"))
    outs.append(F.array_sort(F.collect_set(F.when(other, entry))).alias("others"))
    g = m.groupBy("file_id", "folder", "written_at", "pos").agg(*outs)

    def canonical(v: Column, tag: Column, json: Column) -> Column:
        text, strings = F.try_variant_get(v, "$", "string"), F.try_variant_get(v, "$", "array<string>")
        main = F.coalesce(*[F.try_variant_get(v, f"$.{k}", "string") for k in ("main", "value", "text")], json)
        return F.when(tag == "array", F.array_join(strings, "; ")).when(tag == "object", main).otherwise(text)

    cols: list[Column] = [F.try_variant_get(F.try_parse_json("model_name_json"), "$", "string").alias("model_name")]
    for f in FIELDS:
        v, tag = F.try_parse_json(f"{f}_json"), F.col(f"{f}_tag")
        cols += [
            F.col(f"{f}_key"),
            tag,
            F.when(tag == "string", F.try_variant_get(v, "$", "string")).alias(f"{f}_string"),
            F.when(tag == "number", F.try_variant_get(v, "$", "double")).alias(f"{f}_number"),
            F.when(tag == "boolean", F.try_variant_get(v, "$", "boolean")).alias(f"{f}_boolean"),
            F.when(tag == "array", F.try_variant_get(v, "$", "array<string>")).alias(f"{f}_array"),
            F.when(tag == "object", F.col(f"{f}_json")).alias(f"{f}_object"),
            canonical(v, tag, F.col(f"{f}_json")).alias(f),
        ]
    once = F.filter("others", lambda x, i: (i == 0) | (F.get(F.col("others"), i - 1)["path"] != x["path"]))
    typed = F.transform(once, lambda x: F.struct(x["path"].alias("path"), F.struct(x["tag"].alias("tag"), canonical(F.try_parse_json(x["json"]), x["tag"], x["json"]).alias("text")).alias("value")))
    return g.select("file_id", "folder", "written_at", "pos", *cols, F.map_from_entries(typed).alias("others"))
