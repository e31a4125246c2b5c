"""Note tables: scanning folders of Markdown files, and notes derived from a documents table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notegraph.functions import text as X

# fixed values: what each walk leaves out
REVIEW_FILE = "classification-review.md"
POLICIES = ("classify", "source", "all", "no_hidden", "no_wiki", "audit")


def allowed(path: Column, policy: str = "classify") -> Column:
    """Whether a walk with ``policy`` visits the relative path."""
    top = F.substring_index(path, "/", 1)
    hidden = path.rlike(r"(^|/)\.")
    wiki = top == "wiki"
    backup = path.startswith("Personal-backup")
    name = F.substring_index(path, "/", -1)
    out = F.lit(True)
    if policy in ("classify", "source", "no_hidden", "audit"):
        out = out & ~hidden
    if policy in ("classify", "source", "no_wiki"):
        out = out & ~wiki
    if policy in ("classify", "source"):
        out = out & ~backup
    if policy == "classify":
        out = out & (name != REVIEW_FILE)
    if policy == "audit":
        out = out & ~path.rlike(r"(^|/)_resources(/|$)")
    return out


def scan_notes(spark: SparkSession, root: str, vault: str, policy: str = "classify", recursive: bool = True) -> DataFrame:
    """One row per ``.md`` file below ``root``; rejected paths are dropped before their text is read."""
    raw = (
        spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", "*.md").load(root)
        .select("value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_modification_time").alias("mtime"))
    )
    rel = F.regexp_extract(F.url_decode(F.replace("file_path", F.lit("+"), F.lit("%2B"))), rf"{_quoted(root)}/?(.*)$", 1)
    rows = raw.withColumn("rel_path", rel).where(allowed(F.col("rel_path"), policy))
    return rows.select(F.lit(vault).alias("vault"), "rel_path", *_names(F.col("rel_path")), "mtime", F.col("value").alias("raw"))


def _quoted(root: str) -> str:
    bare = root.split("://", 1)[-1].removeprefix("file:").rstrip("/")
    return "\\Q" + bare + "\\E"


def _names(path: Column) -> list[Column]:
    name = F.substring_index(path, "/", -1)
    folder = F.when(path.contains("/"), F.substring_index(F.regexp_replace(path, "/[^/]*$", ""), "/", -1)).otherwise("")
    return [name.alias("file_name"), F.regexp_replace(name, r"\.md$", "").alias("stem"), folder.alias("folder")]


HEADER_TYPE = T.StructType(
    [T.StructField("ok", T.BooleanType())]
    + [T.StructField(n, T.StringType()) for n in ("title", "type", "org", "context", "up", "project", "classified_by", "slug", "status", "updated", "created")]
    + [T.StructField(n, T.ArrayType(T.StringType())) for n in ("people", "tags", "topics", "aliases", "exclude")]
    + [T.StructField("errors", T.ArrayType(T.StringType())), T.StructField("extra", T.MapType(T.StringType(), T.StringType()))]
)


def parse_header(raw: Column) -> Column:
    """The header block's fields as a struct. Fields of a wrong kind are null and named in ``errors``.

    Python, batch by batch: headers are YAML. Without a YAML library the flat subset (scalars, and lists of scalars
    in either notation) is read; a block outside of it is not ok.
    """
    return _parse_header(X.header_of(raw))


@F.pandas_udf(HEADER_TYPE)
def _parse_header(blocks):
    import pandas as pd

    return pd.DataFrame([_fields(b) for b in blocks], columns=HEADER_TYPE.names)


def _fields(block: str | None) -> tuple:
    names = HEADER_TYPE.names
    found, errors, extra = {}, [], {}
    data = _load(block) if block else None
    ok = isinstance(data, dict)
    for k, v in (data.items() if ok else ()):
        kind = HEADER_TYPE[k].dataType if k in names and k not in ("ok", "errors", "extra") else None
        if kind is None:
            extra[str(k)] = str(v)
        elif isinstance(kind, T.ArrayType):
            if isinstance(v, list):
                found[k] = [str(x) for x in v if x is not None]
            else:
                errors.append(k)
        elif isinstance(v, (list, dict)):
            errors.append(k)
        else:
            found[k] = None if v is None else str(v)
    return tuple({"ok": ok, "errors": errors, "extra": extra}.get(n, found.get(n)) for n in names)


def _load(block: str):
    try:
        import yaml
    except ImportError:
        return _flat(block)
    try:
        return yaml.safe_load(block)
    except yaml.YAMLError:
        return None


def _flat(block: str) -> dict | None:
    out, key = {}, None
    for line in block.split("\n"):
        bare = line.strip()
        if not bare or bare.startswith("#"):
            continue
        if bare.startswith("- ") or bare == "-":
            if key is None or out[key] not in (None, []) and not isinstance(out[key], list):
                return None
            out[key] = [*(out[key] or []), _scalar(bare[1:].strip())]
        elif line[0] not in " \t" and ":" in bare:
            key, _, value = bare.partition(":")
            value = value.strip()
            if value.startswith("[") and value.endswith("]") and not value.startswith("[["):
                inner = value[1:-1].strip()
                out[key] = [_scalar(x.strip()) for x in inner.split(",")] if inner else []
            elif value and value[0] not in "'\"" and ": " in value:
                return None
            else:
                out[key] = _scalar(value) if value else None
        else:
            return None
    return out


def _scalar(x: str):
    return x[1:-1] if len(x) > 1 and x[0] == x[-1] and x[0] in "'\"" else x


def notes_from_documents(documents: DataFrame) -> DataFrame:
    """Notes in the shape of `scan_notes`, from ``(doc_id, text, lang, source)``; null texts are empty."""
    stem = F.concat(F.lit("doc"), F.col("doc_id").cast("string"))
    body = F.coalesce("text", F.lit(""))
    return documents.select(
        "doc_id",
        F.col("lang").alias("vault"),
        F.concat("source", F.lit("/"), stem, F.lit(".md")).alias("rel_path"),
        F.concat(stem, F.lit(".md")).alias("file_name"),
        stem.alias("stem"),
        F.col("source").alias("folder"),
        F.trim(F.regexp_extract(body, r"^[^.!?\n]*", 0)).alias("title"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days=F.expr("doc_id div 1440").cast("int"), mins=(F.col("doc_id") % 1440).cast("int"))).alias("mtime"),
        body.alias("body"),
    )


#: The same view for DuckDB.
NOTES_SQL = r"""notes AS (
  SELECT doc_id, lang AS vault, source || '/doc' || doc_id || '.md' AS rel_path, 'doc' || doc_id || '.md' AS file_name,
         'doc' || doc_id AS stem, source AS folder, trim(regexp_extract(coalesce(text, ''), '^[^.!?\n]*')) AS title,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS mtime, coalesce(text, '') AS body
  FROM documents)"""


def folders(notes: DataFrame) -> DataFrame:
    """Per folder the number of its notes and its newest change."""
    return notes.groupBy("folder").agg(F.count("*").alias("n"), F.max("mtime").alias("newest"))


# --- other sources


def read_json(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """JSON documents with a fixed schema; corrupt ones become no rows, or an error if ``strict``. A missing path is empty."""
    try:
        df = spark.read.schema(f"{schema}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").option("multiLine", True)
        df = df.option("mode", "FAILFAST" if strict else "PERMISSIVE").json(path)
        return df.where(F.col("_corrupt").isNull()).drop("_corrupt")
    except Exception as e:
        if strict or "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def read_review_queue(lines: DataFrame, col: str = "value") -> DataFrame:
    """``(path, type, org, confidence, reason)`` of the rows of a Markdown table; heads and rules are no rows."""
    cells = F.transform(F.split(F.regexp_replace(F.trim(F.col(col)), r"^\||\|$", ""), r"\|"), lambda s: F.trim(s))
    rows = lines.where(F.trim(F.col(col)).startswith("|")).select(cells.alias("c")).where(F.size("c") >= 5)
    conf = F.expr("try_cast(c[3] AS DOUBLE)")
    out = rows.select(F.col("c")[0].alias("path"), F.col("c")[1].alias("type"), F.col("c")[2].alias("org"), conf.alias("confidence"), F.col("c")[4].alias("reason"))
    return out.where(F.col("confidence").isNotNull())


def read_run_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """``decision TAB path [TAB -> type]`` lines as columns; other lines are dropped."""
    parts = F.split(F.col(col), "\t")
    rows = lines.select(parts.alias("p")).where(F.size("p") >= 2)
    return rows.select(F.col("p")[0].alias("decision"), F.col("p")[1].alias("path"), F.regexp_replace(F.get("p", F.lit(2)), r"^->\s*", "").alias("type"))


def nested_tags(tags: Column) -> Column:
    """An underscore in a tag marks nesting and becomes a slash; null is no tag."""
    return F.transform(F.coalesce(tags, F.array().cast("array<string>")), lambda t: F.replace(t, F.lit("_"), F.lit("/")))


def read_relational(spark: SparkSession, url: str, table: str, columns: list[str], **options) -> DataFrame:
    """Some columns of a relational table, by any JDBC driver on the session's class path; options as Spark's reader has."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load().select(*columns)


def guid_lookup(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """``rows (guid, title)`` of a notes database to ``(guid, target)``: the file of a title, by the exact title, the
    lower-cased one, or the one with white space collapsed. GUIDs are lower-cased; unknown titles are left out."""
    from notegraph.operators.joins import resolve_by_fallback

    found = resolve_by_fallback(rows.select(F.lower("guid").alias("guid"), "title"), lookup)
    return found.where("target is not null").select("guid", "target")


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """Note-export XML: title, created, updated, notebook, tags; an underscore in a tag marks nesting and becomes a slash."""
    raw = spark.read.format("xml").option("rowTag", "note").schema("title string, created string, updated string, notebook string, tag array<string>, content string").load(path)
    return raw.select("title", "created", "updated", "notebook", nested_tags(F.col("tag")).alias("tags"), "content")
