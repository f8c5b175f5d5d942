"""Health of raw zones: manifests held against the files that are there, one rule a fault.

Two kinds of zone are checked by the same entry rules: this library's own, whose manifest
is a Parquet dataset, and older ones with one JSON manifest per day folder, whose header
and entries are checked for their types first.  Files come from a distributed listing
(``binaryFile`` paths, contents unread) and meet the entries by joins in both directions.  A finding is a
row (code, path, detail); a healthy zone has none.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators import quality as Q
from lakemart.operators.shaping import union_by_name
from lakemart.sources.raw_zone import artifacts, plain_path

FINDING = T.StructType([T.StructField(c, T.StringType()) for c in ("code", "path", "detail")])

# Fields of a manifest's header and of its entries with their JSON types;
# the last two groups may be absent.
HEADER_FIELDS = ("source_id", "dataset", "partition_date")
ENTRY_TYPES = {
    "source_id": "text",
    "dataset": "text",
    "partition_date": "text",
    "run_id": "text",
    "path": "text",
    "row_count": "whole",
    "written_at": "text",
}
OPTIONAL_ENTRY_TYPES = {
    "provider": "text",
    "source_interface_id": "text",
    "doc_api": "text",
    "partition_key": "list",
    "request_params_hash": "text",
    "schema_hash": "text",
}
OPTIONAL_HEADER_TYPES = {"manifest_version": "whole", **OPTIONAL_ENTRY_TYPES}

#: What a JSON type is called by ``schema_of_variant``.
_CALLED = {"text": r"^STRING$", "whole": r"^(BIGINT|DECIMAL\(\d+,0\))$", "list": r"^ARRAY<"}

#: An entry next to what the place of its manifest says about it.
ENTRY = T.StructType(
    [
        *[T.StructField(c, T.StringType()) for c in ("source_id", "dataset", "partition_date", "run_id", "path", "written_at")],
        T.StructField("row_count", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in ("folder", "folder_source", "folder_dataset", "folder_day")],
    ]
)


# --------------------------------------------------------------- files


def clean_path(path: Column) -> Column:
    """``path`` without empty, ``.`` and ``..`` segments; a ``..`` takes the segment before it along."""
    text = plain_path(path)
    segments = F.aggregate(
        F.split(text, "/"),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part.isin("", "."), done)
        .when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(part))),
    )
    return F.concat(F.regexp_extract(text, r"^(\w+://|/|)", 1), F.array_join(F.filter(segments, lambda p: ~p.rlike(r"^\w+:$")), "/"))


def listed_files(spark: SparkSession, root: str) -> DataFrame:
    """file, folder (its day folder), source, dataset, day, artifact of every file below source and dataset.

    ``artifact``: the file itself, or the ``run_id=`` folder it lies in; NULL for files of other kinds.  Names that
    start with ``_`` or ``.`` are not listed by Spark's readers.
    """
    base = clean_path(F.lit(root))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(plain_path(F.col("path")).alias("file"))
    inside = files.withColumn("_rest", F.substr("file", F.length(base) + 2, F.lit(1 << 30)))
    place = r"^([^/]+)/([^/]+)/([^/]+)/(.+)$"
    part = lambda n: F.regexp_extract("_rest", place, n)
    data = F.col("file").rlike(r"[.](parquet|json[.]gz)$")
    folder = F.concat_ws("/", base, part(1), part(2), part(3))
    in_run = part(4).rlike(r"^run_id=[^/]+/")
    artifact = F.when(data & in_run, F.concat_ws("/", folder, F.regexp_extract(part(4), r"^(run_id=[^/]+)/", 1))).when(data, F.col("file"))
    return inside.where(F.col("_rest").rlike(place) & ~part(1).isin("manifest", "quarantine")).select(
        "file",
        folder.alias("folder"),
        part(1).alias("source"),
        part(2).alias("dataset"),
        part(3).alias("day"),
        artifact.alias("artifact"),
    )


def _read_file() -> Column:
    """The file a row is read from, as ``listed_files`` names it.

    Not ``_metadata.file_path``: conditions on that are evaluated while files are listed, by all branches of a plan at
    once on shared expression objects, and files went missing.
    """
    return plain_path(F.input_file_name()).alias("file")


def _day_of(folder_name: Column) -> Column:
    """The date of a ``dt=YYYYMMDD`` folder as ISO text, NULL for any other name."""
    digits = F.regexp_extract(folder_name, r"^dt=(\d{8})$", 1)
    return F.when(digits != "", F.try_to_date(F.nullif(digits, F.lit("")), "yyyyMMdd")).cast("string")


def folder_findings(files: DataFrame) -> DataFrame:
    """Day folders whose name is no ``dt=`` with a calendar date."""
    folders = files.select("folder", "day").distinct()
    return folders.where(_day_of(F.col("day")).isNull()).select(
        F.lit("day_folder_name").alias("code"), F.col("folder").alias("path"), F.col("day").alias("detail")
    )


# --------------------------------------------------------------- JSON manifests


def _kind(value: Column) -> Column:
    return F.when(value.isNotNull(), F.schema_of_variant(value))


def _field(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "variant")


def _text(value: Column, name: str) -> Column:
    """A field's value if it is a JSON string."""
    return F.when(_kind(_field(value, name)) == "STRING", F.try_variant_get(value, f"$.{name}", "string"))


def _is(value: Column, name: str, kind: str) -> Column:
    return F.coalesce(_kind(_field(value, name)).rlike(_CALLED[kind]), F.lit(False))


def _wrong(value: Column, types: Mapping[str, str], optional: bool) -> Column:
    """Names of the fields whose type is not the expected one, '' for none; an optional field may be absent."""
    faults = []
    for name, kind in types.items():
        bad = ~_is(value, name, kind)
        if optional:
            bad &= _field(value, name).isNotNull()
        faults.append(F.when(bad, F.lit(name)))
    return F.concat_ws(",", *faults)


def manifest_findings(spark: SparkSession, root: str, files: DataFrame, manifest_name: str) -> tuple[DataFrame, DataFrame]:
    """(findings, ENTRY rows) of the JSON manifests among ``files``; ``manifest_name`` is a pattern of file names.

    Only entries whose required fields have their types become rows; what is wrong with the others is found.
    """
    text = (
        spark.read.schema("value string").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", manifest_name).text(root)
        .select(_read_file(), "value")
    )
    parsed = text.join(files.drop("artifact"), "file").withColumn("m", F.try_parse_json("value")).drop("value")
    parsed = parsed.withColumn("is_object", F.coalesce(_kind(F.col("m")).startswith("OBJECT"), F.lit(False)))
    parsed = parsed.withColumn("has_list", _is(F.col("m"), "artifacts", "list"))
    expected = {"source_id": F.col("source"), "dataset": F.col("dataset"), "partition_date": _day_of(F.col("day"))}
    differs = [F.when(~_text(F.col("m"), c).eqNullSafe(expected[c]), F.lit(c)) for c in HEADER_FIELDS]
    # Code, what it says, and whether it applies to the file as a whole or to a readable object.
    rules = [
        ("manifest_unreadable", ~F.col("is_object"), F.lit(None).cast("string")),
        ("header_differs", F.col("is_object") & (F.col("_differs") != ""), F.col("_differs")),
        ("header_type", F.col("is_object") & (F.col("_types") != ""), F.col("_types")),
        ("no_entry_list", F.col("is_object") & ~F.col("has_list"), F.lit(None).cast("string")),
    ]
    judged = parsed.withColumns({"_differs": F.concat_ws(",", *differs), "_types": _wrong(F.col("m"), OPTIONAL_HEADER_TYPES, True)})
    found = [_found(judged, rules, F.col("file"))]

    entries = parsed.where(F.col("has_list")).select(
        "file", "folder", "source", "dataset", "day",
        F.posexplode(F.try_variant_get("m", "$.artifacts", "array<variant>")).alias("place", "e"),
    )
    entries = entries.withColumns(
        {
            "e_object": F.coalesce(_kind(F.col("e")).startswith("OBJECT"), F.lit(False)),
            "_types": _wrong(F.col("e"), ENTRY_TYPES, False),
            "_optional": _wrong(F.col("e"), OPTIONAL_ENTRY_TYPES, True),
        }
    )
    where = F.concat("file", F.lit("["), F.col("place").cast("string"), F.lit("]"))
    entry_rules = [
        ("entry_no_object", ~F.col("e_object"), F.lit(None).cast("string")),
        ("entry_type", F.col("e_object") & (F.col("_types") != ""), F.col("_types")),
        ("entry_optional_type", F.col("e_object") & (F.col("_optional") != ""), F.col("_optional")),
    ]
    found.append(_found(entries, entry_rules, where))
    typed = entries.where(F.col("e_object") & (F.col("_types") == "")).select(
        *[_text(F.col("e"), c).alias(c) for c in ("source_id", "dataset", "partition_date", "run_id", "path", "written_at")],
        F.try_variant_get("e", "$.row_count", "long").alias("row_count"),
        "folder",
        F.col("source").alias("folder_source"),
        F.col("dataset").alias("folder_dataset"),
        _day_of(F.col("day")).alias("folder_day"),
    )
    return union_by_name(found), typed.select(*ENTRY.fieldNames())


def _found(rows: DataFrame, rules: Sequence[tuple[str, Column, Column]], path: Column) -> DataFrame:
    """One finding per row and rule that applies, from a single pass."""
    told = {f"_detail_{code}": detail.cast("string") for code, _, detail in rules}
    codes = F.concat_ws(",", *[F.when(wrong, F.lit(code)) for code, wrong, _ in rules])
    judged = rows.select(path.alias("path"), codes.alias("_codes"), *[detail.alias(name) for name, detail in told.items()]).where(F.col("_codes") != "")
    each = judged.select("*", F.explode(F.split("_codes", ",")).alias("code"))
    detail = F.coalesce(*[F.when(F.col("code") == code, F.col(f"_detail_{code}")) for code, _, _ in rules])
    return each.select("code", "path", detail.alias("detail"))


# --------------------------------------------------------------- entries against files


def entry_findings(entries: DataFrame, files: DataFrame, root: str, own_run_ids: bool = False) -> DataFrame:
    """Findings on ENTRY rows, and the artifacts no entry names.

    ``own_run_ids``: run ids need only be what this library's writer accepts, not one of the generated forms.
    """
    base = clean_path(F.lit(root))
    text = F.trim(F.coalesce(F.col("path"), F.lit("")))
    absolute = text.startswith("/") | text.contains(":/") | text.startswith(F.concat(base, F.lit("/")))
    resolved = clean_path(F.when(absolute, text).otherwise(F.concat(base, F.lit("/"), text)))
    placed = entries.withColumns({"_path": resolved, "_empty": text == ""})
    placed = placed.withColumns({"_name": F.regexp_extract("_path", r"([^/]+)$", 1), "_parent": F.regexp_extract("_path", r"^(.*)/[^/]+$", 1)})
    have = files.where(F.col("artifact").isNotNull()).select(F.col("artifact").alias("_have"), "folder").distinct()
    joined = placed.join(have.drop("folder"), placed["_path"] == have["_have"], "left")
    inside = F.col("_path").startswith(F.concat(base, F.lit("/")))
    names = [F.concat(F.col("run_id"), F.lit(end)) for end in (".parquet", ".json.gz")] + [F.concat(F.lit("run_id="), F.col("run_id"))]
    valid_run = F.col("run_id").rlike(r"^[A-Za-z0-9][A-Za-z0-9_.\-]*$") if own_run_ids else Q.valid_run_id(F.col("run_id"))
    stated = {"source_id": "folder_source", "dataset": "folder_dataset", "partition_date": "folder_day"}
    differs = F.concat_ws(",", *[F.when(~F.col(c).eqNullSafe(F.col(f)), F.lit(c)) for c, f in stated.items()])
    usable = ~F.col("_empty") & inside
    rules = [
        ("path_empty", F.col("_empty"), F.lit(None).cast("string")),
        ("path_outside_zone", ~F.col("_empty") & ~inside, F.col("path")),
        ("entry_differs", differs != "", differs),
        ("run_id_form", ~F.coalesce(valid_run, F.lit(False)), F.col("run_id")),
        ("row_count_negative", F.col("row_count").isNull() | (F.col("row_count") < 0), F.col("row_count").cast("string")),
        ("written_at_no_time", F.col("written_at").try_cast("timestamp").isNull(), F.col("written_at")),
        ("path_not_of_run", usable & ~F.coalesce(F.col("_name").isin(*names), F.lit(False)), F.col("_name")),
        ("path_not_of_day", usable & ~F.coalesce(F.col("_parent") == F.col("folder"), F.lit(False)), F.col("_parent")),
        ("no_such_artifact", usable & F.col("_have").isNull(), F.lit(None).cast("string")),
    ]
    where = F.when(F.col("_empty"), F.col("folder")).otherwise(F.col("_path"))
    repeated = Q.duplicates(entries, ["folder", "run_id"])
    named = placed.select(F.col("_path").alias("_named"))
    orphans = have.join(named, have["_have"] == named["_named"], "left_anti")
    return union_by_name(
        [
            _found(joined, rules, where),
            repeated.select(F.lit("run_id_repeated").alias("code"), F.col("folder").alias("path"), F.col("run_id").alias("detail")),
            orphans.select(F.lit("not_in_manifest").alias("code"), F.col("_have").alias("path"), F.lit(None).cast("string").alias("detail")),
        ]
    )


def row_count_findings(spark: SparkSession, entries: DataFrame, files: DataFrame, root: str) -> DataFrame:
    """Artifacts whose rows differ in number from their entry, and those that cannot be read.

    Parquet rows are counted from the footers, JSON artifacts as arrays, single objects or one object a line.  Files
    that are damaged are passed over by the readers and so have no count.
    """
    base = clean_path(F.lit(root))
    text = F.trim(F.coalesce(F.col("path"), F.lit("")))
    absolute = text.startswith("/") | text.contains(":/")
    keyed = entries.select(clean_path(F.when(absolute, text).otherwise(F.concat(base, F.lit("/"), text))).alias("_path"), "row_count")
    place = files.where(F.col("artifact").isNotNull()).select("file", "artifact")

    def reader(schema):
        return spark.read.schema(schema).option("recursiveFileLookup", True).option("ignoreCorruptFiles", True)

    rows = reader(T.StructType([])).option("pathGlobFilter", "*.parquet").parquet(root).select(_read_file()).groupBy("file").agg(F.count("*").alias("rows"))
    line = F.try_parse_json("value")
    kind = F.schema_of_variant(line)
    size = F.when(kind.startswith("ARRAY"), F.size(F.try_variant_get(line, "$", "array<variant>"))).when(kind.startswith("OBJECT"), 1)
    whole = reader("value string").option("pathGlobFilter", "*.json.gz").option("wholetext", True).text(root).select(_read_file(), "value")
    # One value for the whole file, or (NULL there) one a line.
    lines = F.transform(F.filter(F.split("value", "\n"), lambda v: F.trim(v) != ""), lambda v: F.coalesce(F.schema_of_variant(F.try_parse_json(v)).startswith("OBJECT"), F.lit(False)))
    by_line = F.when(F.forall(lines, lambda ok: ok), F.size(lines))
    json = whole.select("file", F.coalesce(size, by_line).cast("long").alias("rows"))
    counts = place.join(rows.unionByName(json), "file", "left").groupBy("artifact").agg(F.sum("rows").alias("rows"), F.count("rows").alias("read"), F.count("*").alias("files"))
    # A Parquet file without rows yields no group; it is damaged only if rows are expected of it.
    joined = keyed.join(counts, keyed["_path"] == counts["artifact"])
    rows_found = F.coalesce("rows", F.lit(0))
    unread = (F.col("read") == 0) & (F.col("row_count") > 0)
    told = F.concat(F.col("row_count").cast("string"), F.lit(" in the manifest, "), rows_found.cast("string"), F.lit(" in the files"))
    return _found(
        joined,
        [
            ("artifact_unreadable", unread, F.lit(None).cast("string")),
            ("row_count_differs", ~unread & (F.col("row_count") != rows_found), told),
        ],
        F.col("_path"),
    )


# --------------------------------------------------------------- zones


def zone_report(spark: SparkSession, root: str, manifest_name: str = "manifest.json", deep: bool = False) -> DataFrame:
    """Findings on an older zone: ``<root>/<source>/<dataset>/dt=YYYYMMDD`` with artifacts and a JSON manifest each.

    ``manifest_name`` is a pattern of visible file names; ``deep`` counts the rows of every artifact.
    """
    files = listed_files(spark, root)
    found, entries = manifest_findings(spark, root, files, manifest_name)
    parts = [folder_findings(files), found, entry_findings(entries, files, root)]
    if deep:
        parts.append(row_count_findings(spark, entries, files, root))
    return union_by_name(parts)


def health_report(spark: SparkSession, root: str, deep: bool = False) -> DataFrame:
    """Findings on a zone of this library, by the same entry rules."""
    files = listed_files(spark, root)
    base = clean_path(F.lit(root))
    day = F.concat(F.lit("dt="), F.date_format("partition_date", "yyyyMMdd"))
    entries = artifacts(spark, root).select(
        "source_id", "dataset", F.col("partition_date").cast("string").alias("partition_date"), "run_id", "path",
        F.col("written_at").cast("string").alias("written_at"), "row_count",
        F.concat_ws("/", base, "source_id", "dataset", day).alias("folder"),
        F.col("source_id").alias("folder_source"), F.col("dataset").alias("folder_dataset"),
        F.col("partition_date").cast("string").alias("folder_day"),
    )
    parts = [folder_findings(files), entry_findings(entries, files, root, own_run_ids=True)]
    if deep:
        parts.append(row_count_findings(spark, entries, files, root))
    return union_by_name(parts)


# --------------------------------------------------------------- exploded manifests


def manifest_violations(entries: DataFrame, folders: DataFrame, root: str) -> DataFrame:
    """Manifest entries that disagree with their header, their file or the run id rules, with the rules they break.

    ``entries`` is ``explode_manifests`` output (all text); ``folders`` lists existing artifact paths.  A path
    may stand absolute or relative to the root; it is made absolute first, so that one equality joins both.
    """
    have = folders.select(clean_path(F.col("path")).alias("_have")).distinct()
    text = F.trim(F.coalesce(F.col("path"), F.lit("")))
    absolute = text.startswith("/") | text.contains(":/")
    placed = entries.withColumn("_path", clean_path(F.when(absolute, text).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), text))))
    joined = placed.join(have, placed["_path"] == have["_have"], "left")
    no_date = lambda c: F.col(c).cast("string").try_cast("date").isNull()
    differs = [~F.col(f"manifest_{c}").eqNullSafe(F.col(c)) for c in HEADER_FIELDS]
    rules = {
        "header_mismatch": differs[0] | differs[1] | differs[2],
        "bad_partition_date": no_date("partition_date") | no_date("manifest_partition_date"),
        "bad_run_id": ~F.coalesce(Q.valid_run_id(F.col("run_id")), F.lit(False)),
        "missing_path": text == "",
        "artifact_missing": F.col("_have").isNull(),
        "bad_row_count": F.col("row_count").isNull() | (F.col("row_count") < 0),
        "bad_written_at": F.col("written_at").cast("string").try_cast("timestamp").isNull(),
    }
    found = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    return joined.withColumn("violations", F.array_join(found, ",")).where(F.size(found) > 0).drop("_path", "_have")
