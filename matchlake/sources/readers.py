"""Readers: nested documents, ids from storage paths, rosters, envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import id_from_path
from ..operators.nested import explode_child, flatten_struct
from ..schemas import MATCH


# The raw text of a document that does not parse; null for all others.
CORRUPT = "_corrupt_record"


# Fields that the schema does not name: path -> JSON text.
OPEN_FIELDS = "open_fields"


def _step(key: Column) -> Column:
    """A key as part of a path; unusual ones are quoted, so that paths do not clash."""
    return F.when(key.rlike("^[A-Za-z_][A-Za-z0-9_]*$"), key).otherwise(F.concat(F.lit("["), F.to_json(F.array(key)).substr(F.lit(2), F.length(F.to_json(F.array(key))) - 1)))


def _unnamed(doc: Column, schema: T.StructType, prefix: Column) -> Column:
    """array<struct<path, value>> of the fields of a VARIANT object that ``schema`` does not name, at any depth; the
    schema bounds the depth that is looked into, what is unknown is kept whole."""
    names = [f.name for f in schema.fields]
    entries = F.map_entries(doc.try_cast("map<string,variant>"))
    found = [F.transform(F.filter(entries, lambda e: ~e["key"].isin(names)),
                         lambda e: F.struct(F.concat(prefix, _step(e["key"])).alias("path"), F.to_json(e["value"]).alias("value")))]
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            found.append(_unnamed(F.try_variant_get(doc, f"$.{f.name}", "variant"), f.dataType, F.concat(prefix, F.lit(f"{f.name}."))))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            found.append(_unnamed_in_list(doc, f, prefix))
    none = F.array().cast("array<struct<path:string,value:string>>")
    return F.concat(*[F.coalesce(x, none) for x in found])


def _unnamed_in_list(doc: Column, f: T.StructField, prefix: Column) -> Column:
    items = F.try_variant_get(doc, f"$.{f.name}", "array<variant>")
    return F.flatten(F.transform(items, lambda x, i: _unnamed(
        x, f.dataType.elementType, F.concat(prefix, F.lit(f"{f.name}["), i.cast("string"), F.lit("].")))))


def open_fields(text: Column, schema: T.StructType) -> Column:
    """map<path, JSON text> of what ``schema`` leaves out of a JSON document; empty if nothing or not JSON."""
    return F.map_from_entries(_unnamed(F.try_parse_json(text), schema, F.lit("")))


def field_drift(docs: DataFrame) -> DataFrame:
    """(path, n_documents, n_values): fields beside the schema, all places of a list together, of documents read with
    ``with_open`` (or of the star's ``open_fields`` table)."""
    if "path" in docs.columns:
        rows = docs.select(F.struct("matchid", "part").alias("doc"), "path")
    else:
        rows = docs.select(F.map_keys(OPEN_FIELDS).alias("paths")).withColumn("doc", F.monotonically_increasing_id()) \
            .select("doc", F.explode("paths").alias("path"))
    per_doc = rows.groupBy("doc", F.regexp_replace("path", r"\[[0-9]+\]", "[]").alias("path")).agg(F.count(F.lit(1)).alias("n"))
    return per_doc.groupBy("path").agg(F.count(F.lit(1)).alias("n_documents"), F.sum("n").alias("n_values"))


def _parse_whole(files: DataFrame, schema: str, with_open: bool = False) -> DataFrame:
    """One document per file; a file that holds several (JSON Lines) is malformed, not cut to its first."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    # whole documents on lines of their own; what is nested in a pretty-printed one is indented
    lines = F.filter(F.split("value", "\n"), lambda x: x.startswith("{") & F.rtrim(x).endswith("}") & F.get_json_object(x, "$").isNotNull())
    parsed = files.select("value", (F.size(lines) > 1).alias("_several"), *[c for c in files.columns if c != "value"],
                          F.from_json("value", f"{schema}, {CORRUPT} string", options).alias("d"))
    named = T.StructType([f for f in parsed.schema["d"].dataType if f.name != CORRUPT])
    bad = F.col("_several") | F.col(f"d.{CORRUPT}").isNotNull()
    beside = [F.when(~bad, open_fields(F.col("value"), named)).alias(OPEN_FIELDS)] if with_open else []
    return parsed.select(*[F.when(~bad, F.col(f"d.`{n}`")).alias(n) for n in named.names], *beside, F.when(bad, F.col("value")).alias(CORRUPT),
                         *[c for c in files.columns if c != "value"])


def documents_from(reader, path, schema: str = MATCH, multi_line: bool = False, with_path: bool = False,
                   with_open: bool = False) -> DataFrame:
    """``read_documents`` over a ``spark.read`` or ``spark.readStream`` reader."""
    source = F.col("_metadata.file_path").alias("source_path")
    if multi_line or with_open:
        files = reader.text(path, wholetext=multi_line).select("value", *([source] if with_path else []))
        return _parse_whole(files if multi_line else files.filter(F.trim("value") != ""), schema, with_open)
    df = reader.schema(f"{schema}, {CORRUPT} string").option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return df.withColumn("source_path", F.col("_metadata.file_path")) if with_path else df


def read_documents(spark: SparkSession, path: str | list[str], schema: str = MATCH,
                   multi_line: bool = False, with_path: bool = False, with_open: bool = False) -> DataFrame:
    """One row per JSON document, parsed with an explicit schema.

    ``multi_line=True`` reads one (pretty-printed) document per file --
    such files cannot be split, so each is one task; JSON Lines
    (``multi_line=False``) splits into ``maxPartitionBytes`` chunks.
    ``with_path`` adds ``source_path`` from the file metadata.  A document
    that does not parse keeps its text in ``_corrupt_record``.  ``with_open``
    adds the map ``open_fields`` with every field, at any depth, that the schema
    does not name (path -> JSON text), so nothing of a document is lost.
    """
    return documents_from(spark.read, path, schema, multi_line, with_path, with_open)


def unknown_fields(spark: SparkSession, path: str, schema: str = MATCH) -> DataFrame:
    """(field, n_documents): top-level fields of JSON Lines documents that ``schema`` does not name, and so drops."""
    known = [f.name for f in spark.createDataFrame([], schema).schema]
    keys = spark.read.text(path).select(F.explode(F.json_object_keys("value")).alias("field"))
    return keys.filter(~F.col("field").isin(known)).groupBy("field").agg(F.count(F.lit(1)).alias("n_documents"))


def ids_from_paths(df: DataFrame, path_col: str = "source_path", id_col: str = "matchid") -> DataFrame:
    """Distinct document ids taken from file paths / URLs (last segment)."""
    return df.select(id_from_path(path_col).alias(id_col)).distinct()


# Fixed value: the value of the last folder's ``key=value`` name.
FOLDER_VALUE = r"=([^/=]*)/[^/]+$"


def list_stored_ids(spark: SparkSession, folder: str | list[str], id_col: str = "matchid",
                    glob: str = "*.json", by_folder: bool = False) -> DataFrame:
    """Ids of stored documents from the file listing only (content unread): the files' names, or with ``by_folder``
    those of the ``key=<id>`` folders that they lie in, of one or several landing folders."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder)
             .select("path"))
    return files.select((id_from_path("path", FOLDER_VALUE) if by_folder else id_from_path("path")).alias(id_col)).distinct()


def map_to_rows(df: DataFrame, col: str, key: str = "key", value: str = "value",
                value_type: str = "string", keep=()) -> DataFrame:
    """JSON object text (``{"name": "tag", ...}``) -> one row per entry."""
    parsed = F.from_json(F.col(col), f"map<string,{value_type}>")
    return df.select(*keep, F.explode(parsed).alias(key, value))


def explode_envelope(df: DataFrame, keep=("name", "tag", "endpoint", "status"),
                     data: str = "data", alias: str = "match") -> DataFrame:
    """API response envelope -> one row per contained document."""
    return explode_child(df, data, keep=list(keep), alias=alias)


# Fixed value: the map name the asset loader leaves out (a practice map).
SKIPPED_MAP = "The Range"


def maps_callouts(maps: DataFrame, skip_name: str | None = SKIPPED_MAP, digits: int = 1) -> DataFrame:
    """Map callout dimension from ``{data: [{uuid, displayName, callouts}]}``.

    Maps named ``skip_name`` are left out (NULL names are kept), callouts
    are flattened and locations rounded half-up to ``digits``.
    """
    from ..functions.numeric import round_dec

    m = explode_child(maps, "data", alias="m", expand=True)
    if skip_name is not None:
        m = m.filter(~F.col("displayName").eqNullSafe(F.lit(skip_name)))
    c = explode_child(m, "callouts", keep=["uuid", "displayName"], alias="c", expand=True)
    c = flatten_struct(c, ["location"])
    return c.select("uuid", "displayName", "regionName", "superRegionName",
                    round_dec("location_x", digits).alias("location_x"),
                    round_dec("location_y", digits).alias("location_y"))
