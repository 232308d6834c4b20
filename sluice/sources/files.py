"""File sources: JSONL, any Spark format, binary objects, listings and reads driven by an index of files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.classic.column import Column as ClassicColumn
from pyspark.sql.window import Window

from sluice.functions.scalar import metadata_path, normalize_path
from sluice.sources.by_reference import lines_of, with_existence

JSONL_GLOB = "*.{jsonl,jsonl.gz}"
CORRUPT = "_corrupt_record"
REST = "_rest"

# File suffix to Spark format.
FORMATS = {
    "parquet": "parquet", "orc": "orc", "csv": "csv", "json": "json", "jsonl": "json", "txt": "text", "text": "text",
}


def as_struct(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def infer_schema(spark: SparkSession, path: str | list[str], glob: str = JSONL_GLOB, recursive: bool = False) -> T.StructType:
    """Schema over all records of the files. This reads them once; pass a schema for large inputs."""
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower())
    found = reader.option("columnNameOfCorruptRecord", CORRUPT).json(path).schema
    return T.StructType([f for f in found.fields if f.name != CORRUPT])


#: Numbers that the decoder knows and the JSON functions do not.
NON_FINITE = r"\b(?:NaN|Infinity|INF)\b"


def _finite(line: Column) -> Column:
    """A line with empty strings, and with 0 for every NaN and infinity outside of them.

    Escaped backslashes and quotes go first, so that a string is what stands between two quotes; the replacement is a letter, which
    keeps a line broken that has a backslash outside of a string.
    """
    plain = F.replace(F.replace(line, F.lit("\\\\"), F.lit("x")), F.lit('\\"'), F.lit("x"))
    return F.regexp_replace(F.regexp_replace(plain, '"[^"]*+"', '""'), "[-+]?" + NON_FINITE, "0")


def _one_record(line: Column) -> Column:
    """Whether a line is exactly one JSON value. The decoder stops after the first value and ignores what follows.

    Put into an array, the line must be its only element; put into an object, its only member. A closing bracket or brace
    that ends one of the two early breaks the other. Both count without decoding. They know no NaN or infinity, so on lines with these
    words they look at the line without its strings and with numbers in place of the words.
    """
    def alone(value: Column) -> Column:
        element = F.json_array_length(F.concat(F.lit("["), value, F.lit("]"))) == 1
        member = F.size(F.json_object_keys(F.concat(F.lit('{"r":'), value, F.lit("}")))) == 1
        return F.coalesce(element & member, F.lit(False))

    return F.when(line.rlike(NON_FINITE), alone(_finite(line))).otherwise(alone(line))


def has_rest(schema: T.StructType) -> bool:
    """Whether rows carry the fields of their record that the schema does not name."""
    return any(f.name == REST and isinstance(f.dataType, T.VariantType) for f in schema.fields)


def _unnamed(line: Column, names: list[str]) -> Column:
    """A VARIANT object of the fields of a record that are not named, null without any. Of fields of one name the last counts."""
    fields = F.from_json(line, T.MapType(T.StringType(), T.VariantType()))
    other = F.map_filter(fields, lambda k, v: ~k.isin(names)) if names else fields
    last = F.filter(F.map_entries(other), lambda e, i: ~F.array_contains(F.slice(F.map_keys(other), i + 2, F.size(other)), e["key"]))
    return F.when(F.size(other) > 0, F.parse_json(F.to_json(F.map_from_entries(last)))).cast(T.VariantType())


def parse_lines(
    lines: DataFrame, schema: str | T.StructType, on_error: str, carried: list[str], open_records: bool = False, corrupt: str = CORRUPT,
) -> DataFrame:
    """Decode a ``value`` column of JSON lines; blank lines are no records.

    Undecodable lines, and lines that do not fit the schema, are dropped, kept with their text in
    ``_corrupt_record`` (``quarantine``) or fail the job. With ``open_records`` the fields that the schema does not name are in the VARIANT
    column ``_rest``, which the JSON sinks put back into the records; fields inside a named structure belong to its type.
    """
    if on_error not in ("drop", "quarantine", "fail"):
        raise ValueError(f"on_error is drop, quarantine or fail, not {on_error!r}")
    fields = [f for f in as_struct(schema).fields if f.name != corrupt and not (open_records and f.name == REST)]
    full = T.StructType(fields + [T.StructField(corrupt, T.StringType())])
    mode = "FAILFAST" if on_error == "fail" else "PERMISSIVE"
    record = F.from_json("value", full, {"mode": mode, "columnNameOfCorruptRecord": corrupt})
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    if on_error == "fail":
        refused = F.from_json(F.concat(F.lit("{not one record: "), F.col("value")), full, {"mode": mode, "columnNameOfCorruptRecord": corrupt})
    else:
        refused = F.struct(*nothing, F.col("value").alias(corrupt))
    one = _one_record(F.col("value"))
    rest = [F.when(one, _unnamed(F.col("value"), [f.name for f in fields])).alias(REST)] if open_records else []
    record = F.when(one, record).otherwise(refused)
    # A generator keeps the filter below from being merged with the decoding, which would then run twice per line.
    parsed = lines.filter(F.trim("value") != "").select(F.inline(F.array(record)), *rest, *carried)
    if open_records:  # a line that does not fit the schema is kept as it is
        parsed = parsed.withColumn(REST, F.when(F.col(corrupt).isNull(), F.col(REST)) if on_error != "fail" else F.col(REST))
    if on_error == "drop":
        parsed = parsed.filter(F.col(corrupt).isNull())
    return parsed if on_error == "quarantine" else parsed.drop(corrupt)


def _file_column() -> Column:
    return metadata_path(F.col("_metadata.file_path")).alias("input_file")


def file_positions(scan: DataFrame) -> DataFrame:
    """Add ``input_file`` and the 0-based ``row_pos`` of each row in its file to a bare file scan.

    Parquet knows its row numbers. Elsewhere rows are counted per input split, whose byte offset gives the
    order of the splits of a file, so a huge file is numbered by as many tasks as it has splits.
    """
    if "row_index" in scan.select("_metadata").schema["_metadata"].dataType.fieldNames():
        return scan.select("*", _file_column(), F.col("_metadata.row_index").alias("row_pos"))
    return _split_positions(scan.select("*", _file_column(), F.col("_metadata.file_block_start").alias("__block")))


def _split_positions(tagged: DataFrame) -> DataFrame:
    """Number rows that carry ``input_file`` and the split offset ``__block``, in scan order."""
    keys = ["input_file", "__block"]
    ordered = tagged.withColumn("__id", F.monotonically_increasing_id())
    before = Window.partitionBy("input_file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    splits = ordered.groupBy(*keys).agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    starts = splits.select(*keys, "__first", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    kept = [F.col(f"`{c}`") for c in tagged.columns if c != "__block"]
    position = (F.col("__start") + F.col("__id") - F.col("__first")).cast("bigint")
    return ordered.join(starts, keys, "inner").select(*kept, position.alias("row_pos"))


def read_jsonl(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType | None = None,
    recursive: bool = False,
    on_error: str = "drop",
    keep_file: bool = False,
    positions: bool = False,
    glob: str = JSONL_GLOB,
    open_records: bool = False,
) -> DataFrame:
    """Read ``.jsonl`` and ``.jsonl.gz`` files of a directory.

    ``open_records`` keeps the fields that the schema does not name in the VARIANT column ``_rest``. ``keep_file`` adds the ``input_file`` of each row, ``positions`` also its ``row_pos`` among the records of
    that file. A gzip file is one task; repartition after reading when such files are large.
    """
    schema = schema or infer_schema(spark, path, glob, recursive)
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower())
    lines = reader.text(path)
    if not (keep_file or positions):
        return parse_lines(lines, schema, on_error, [], open_records)
    if "input_file" in as_struct(schema).fieldNames():
        raise ValueError("the records have an input_file of their own; leave it out of the schema")
    lines = lines.select("value", _file_column(), F.col("_metadata.file_block_start").alias("__block"))
    if positions:
        return _split_positions(parse_lines(lines, schema, on_error, ["input_file", "__block"], open_records))
    return parse_lines(lines, schema, on_error, ["input_file"], open_records)


def read_written(spark: SparkSession, path: str, fmt: str, schema: T.StructType, stream: bool = False, **options: str) -> DataFrame:
    """Rows of a folder that the sinks have written, as a table or as a stream, with ``_metadata``.

    Records that carry a ``_rest`` are read as lines again. Quarantined lines are a column like others here.
    """
    reader = (spark.readStream if stream else spark.read).options(**options)
    if fmt == "json" and has_rest(schema):
        lines = reader.text(path).select("value", "_metadata")
        rows = parse_lines(lines, schema, "drop", ["_metadata"], open_records=True, corrupt="__undecodable")
        return rows.select(*[F.col(f"`{f.name}`") for f in schema.fields], "_metadata")
    return reader.format(fmt).schema(schema).option("columnNameOfCorruptRecord", "__undecodable").load(path)


def format_of(path: str) -> str:
    """Spark format by the suffix of a path, ignoring a compression suffix."""
    name = path.rstrip("/").split("/")[-1].lower()
    for codec in (".gz", ".bz2", ".zst", ".snappy", ".lz4"):
        name = name.removesuffix(codec)
    suffix = name.rsplit(".", 1)[-1]
    if "." not in name or suffix not in FORMATS:
        raise ValueError(f"cannot tell the format of {path!r}; pass fmt")
    return FORMATS[suffix]


def read_any(
    spark: SparkSession, path: str, fmt: str | None = None, schema: str | T.StructType | None = None, **options: str
) -> DataFrame:
    """Read a path in any Spark format; the format follows from the suffix unless given.

    CSV files have no header and one record per line, so that large files are split; pass ``header="true"`` or
    ``multiLine="true"`` for others.
    """
    fmt = fmt or format_of(path)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("escape", '"')  # as write_any writes it
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load(path)


def list_files(spark: SparkSession, path: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """``path, modificationTime, length`` of each file; contents are not read."""
    return read_binary(spark, path, glob, recursive).select("path", "modificationTime", "length")


def all_files(spark: SparkSession, path: str | list[str], glob: str = "*", recursive: bool = False) -> DataFrame:
    """``input_file`` of each file, with the empty ones that scans and :func:`list_files` pass over."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    found = reader.option("recursiveFileLookup", str(recursive).lower()).load(path)
    # The names stay in the JVM, where the reader's listing has them: an array that is taken apart by a task.
    names = ClassicColumn(spark._jvm.org.apache.spark.sql.functions.lit(found._jdf.inputFiles()))
    rows = spark.range(1, numPartitions=1).select(F.explode(names).alias("path"))
    return rows.select(metadata_path(F.col("path")).alias("input_file")).distinct()


def read_binary(spark: SparkSession, path: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """Whole files as ``path, modificationTime, length, content``."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    return reader.option("recursiveFileLookup", str(recursive).lower()).load(path)


def read_objects(spark: SparkSession, refs: DataFrame, root: str, path_col: str = "input_file") -> DataFrame:
    """The whole files that references name, with the columns of the reference, ``content``, ``_error`` and ``_error_msg``.

    A file that does not exist keeps its row with ``_error = "read_error"`` and no content. The files lie below ``root``.
    """
    named = refs.withColumn("__path", normalize_path(F.col(path_col)))
    objects = read_binary(spark, root, recursive=True).select(normalize_path(F.col("path")).alias("__path"), "content")
    missing = F.col("content").isNull()
    return named.join(objects, "__path", "left").drop("__path").withColumns({
        "_error": F.when(missing, "read_error"), "_error_msg": F.when(missing, F.concat(F.lit("no such file: "), F.col(path_col)))})


HIDDEN = r"/[._][^/]*$"


def file_place(spark: SparkSession, path: str) -> tuple:
    """The file system of a path and the path in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists in the file system of its scheme."""
    system, place = file_place(spark, path)
    return system.exists(place)


def list_folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Sorted names of the folders in a folder that begin so; for the few folders of a log."""
    system, place = file_place(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place) if s.isDirectory() and s.getPath().getName().startswith(prefix))


def make_folder(spark: SparkSession, path: str) -> None:
    system, place = file_place(spark, path)
    system.mkdirs(place)


def remove_folders(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders that this library has written."""
    for path in paths:
        system, place = file_place(spark, path)
        system.delete(place, True)


def _whole_path(spark: SparkSession, path: str) -> tuple[str, str]:
    """A folder in the spelling of listings, and what stands before its first slash there."""
    system, place = file_place(spark, path)
    whole = system.makeQualified(place)
    spelled = re.sub(r"^s3n?://", "s3a://", re.sub(r"^file:/+", "file:/", whole.toString()))
    return spelled.rstrip("/") + "/", spelled.removesuffix(whole.toUri().getPath())


def existing_refs(spark: SparkSession, refs: DataFrame) -> DataFrame:
    """References whose file exists now, tested in tasks."""
    return with_existence(refs.filter(F.col("input_file").isNotNull())).filter("exists").drop("exists")


def read_by_index(
    spark: SparkSession,
    index: DataFrame,
    schema: str | T.StructType,
    root: str | None = None,
    on_error: str = "drop",
    by_name: bool = False,
    tested: bool = False,
) -> DataFrame:
    """Records of the files that an index names, with ``input_file`` and the ``track_id`` of the index.

    Files that do not exist are left out. The folder ``root`` above all files is scanned and joined with the index, whatever
    its length; a file with a large part of all rows is split by the skew join. A reference outside ``root``, or to a name that
    readers hide (``_x``, ``.x``), is an error.

    With ``by_name`` the tasks open the files themselves (see :mod:`sluice.sources.by_reference`): nothing is listed, ``root`` is not needed,
    and neither references nor files pass through the driver. A file is read by one task. If the references are ``tested`` already, a file
    that is gone since is an error. Where the records have fields of these names themselves, the added columns are ``ref_input_file`` and
    ``ref_track_id``.
    """
    names = as_struct(schema).fieldNames()
    file_col, track_col = ("ref_" + c if c in names else c for c in ("input_file", "track_id"))
    refs = index.filter(F.col("input_file").isNotNull()).select(
        normalize_path(F.col("input_file")).alias(file_col), F.col("track_id").cast("string").alias(track_col)
    ).distinct()
    if by_name:
        lines = lines_of(refs, file_col, track_col, "fail" if tested else "skip")
        return parse_lines(lines, schema, on_error, [file_col, track_col])
    if not root:
        raise ValueError("read_by_index needs the folder above all files (root), or by_name")
    base, system = _whole_path(spark, root)
    bare = F.col(file_col).startswith("/")
    refs = refs.withColumn(file_col, F.when(bare, F.concat(F.lit(system), file_col)).otherwise(F.col(file_col)))
    strange = ~F.col(file_col).startswith(base) | F.col(file_col).rlike(HIDDEN)
    odd = [r[0] for r in refs.filter(strange).select(file_col).limit(5).collect()]
    if odd:
        raise ValueError(f"references outside {root!r}, or to hidden names: {odd}")
    lines = spark.read.option("recursiveFileLookup", "true").text(root).select("value", metadata_path(F.col("_metadata.file_path")).alias(file_col))
    return parse_lines(lines.join(refs, file_col), schema, on_error, [file_col, track_col])
