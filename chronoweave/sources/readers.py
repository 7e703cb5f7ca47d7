"""Session files to DataFrames: explicit schemas, tolerant values, file order kept as ``row_id``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.scalars import finite

#: Time columns of each stream kind, first match wins, with the factor to milliseconds.
TIME_COLUMNS = [("timestamp_ns", 1e-6), ("t_ms_corrected_ns", 1e-6), ("t_ms", 1.0), ("time_seconds", 1e3)]
FRAME = T.StructType([T.StructField("index", T.LongType()), T.StructField("frame_index", T.LongType()), T.StructField("capture_time", T.DoubleType()), T.StructField("capture_timestamp_sec", T.DoubleType())])
METADATA = "struct<session_id:string,operator:string,scenario:string,start_time_ns:bigint,end_time_ns:bigint,trigger_time_ns:bigint,duration_seconds:double,failed:boolean,check_score:double,check_grade:string,cameras:map<string,struct<name:string,position:string,serial:string>>,trackers:map<string,struct<serial:string,model:string>>,grippers:map<string,struct<port:string,baud:string>>>"
SESSION = r"/([^/]+)/(?:videos/|cameras/|sensors/)?[^/]+$"


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """path, session_id, row_id, line of small text files; lines end in CR, LF or CRLF, blank ones go.

    Whole files keep the line order, which a split read would lose."""
    whole = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    lines = whole.select("path", F.posexplode(F.split("value", "\r\n|\r|\n")).alias("row_id", "line")).where("trim(line) <> ''")
    return lines.withColumn("session_id", F.regexp_extract("path", SESSION, 1))


SEPARATORS = (",", ";", "\t")


def read_csv(spark: SparkSession, paths: str | Sequence[str], required: Sequence[str] = (), delimiter: str | None = None) -> DataFrame:
    """Files as strings with session_id, path and row_id; raises if a file lacks a required column.

    Every file is read by its own header, its first line that is not blank, so columns may stand in another order or with
    another delimiter from file to file; a column that a file lacks is null. Header and lines go through the same parser, so
    quoted names may hold the delimiter. One scan finds the distinct headers, which reach the driver, one more reads the rows,
    however many headers there are; nothing is shuffled."""
    whole = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.split("value", "\r\n|\r|\n").alias("_lines"))
    files = whole.withColumn("_head", F.try_element_at(F.filter("_lines", lambda x: F.trim(x) != ""), F.lit(1))).where("_head is not null")
    several = lambda d: F.size(F.split("_head", d)) >= 2
    sep = F.lit(delimiter) if delimiter else F.when(several(","), ",").when(several(";"), ";").when(several("\t"), "\t").otherwise(",")
    files = files.withColumn("_sep", sep)
    width = files.agg(F.max(F.size(F.split("_head", r"[,;\t]" if not delimiter else f"\\Q{delimiter}\\E")))).first()[0]
    if width is None:
        raise ValueError("no rows")
    schema = ", ".join(f"c{i} string" for i in range(width))
    choices = (delimiter,) if delimiter else SEPARATORS

    def cells(line: str):
        parsed = F.lit(None).cast("array<string>")
        for d in choices:
            one = F.from_csv(line, schema, {"sep": d})
            parsed = F.when(F.col("_sep") == d, F.array(*[one[f"c{i}"] for i in range(width)])).otherwise(parsed)
        return parsed

    files = files.withColumn("_names", F.transform(F.filter(cells("_head"), lambda x: x.isNotNull()), F.trim))
    kinds = [r["_names"] for r in files.groupBy("_names").agg(F.min("_head").alias("h")).orderBy("h").collect()]
    for names in kinds:
        if missing := set(required) - set(names):
            raise ValueError(f"missing columns: {', '.join(sorted(missing))}")
    columns = list(dict.fromkeys(n for names in kinds for n in names))
    rows = files.select("path", "_sep", "_names", "_head", F.array_position("_lines", F.col("_head")).alias("_at"), F.posexplode("_lines").alias("row_id", "_line")).where("row_id >= _at and trim(_line) <> ''")
    rows = rows.select("path", "row_id", "_names", cells("_line").alias("_cells"))
    value = lambda n: F.try_element_at("_cells", F.nullif(F.array_position("_names", F.lit(n)), F.lit(0)).cast("int")).alias(n)
    return rows.select(F.regexp_extract("path", SESSION, 1).alias("session_id"), "path", "row_id", *[value(n) for n in columns])


def numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles; text, NaN and infinite values become null."""
    return df.withColumns({c: finite(F.col(c).try_cast("double")) for c in columns if c in df.columns})


def with_time_ms(df: DataFrame) -> DataFrame:
    """t_ms from the first time column there is."""
    for name, factor in TIME_COLUMNS:
        if name in df.columns:
            exact = F.col(name).try_cast("bigint")
            return df.withColumn("t_ms", F.coalesce(exact * F.lit(factor), finite(F.col(name).try_cast("double")) * factor))
    raise ValueError("no time column")


def read_tracker(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Tracker samples in long form: session_id, row_id, t_ms, block (head, left, right), pos and quat (w, x, y, z)."""
    wide = with_time_ms(read_csv(spark, paths))
    prefix = lambda r: f"tracker_{r}_" if f"tracker_{r}_x" in wide.columns else f"{r}_"
    roles = [r for r in ("head", "left", "right") if prefix(r) + "x" in wide.columns]
    if not roles:
        wide, roles, prefix = _anonymous(wide)
    d = lambda r, k: finite(F.col(prefix(r) + k).try_cast("double"))
    blocks = F.array(*[F.struct(F.lit(r).alias("block"), F.array(*[d(r, k) for k in "xyz"]).alias("pos"), F.array(*[d(r, k) for k in ("qw", "qx", "qy", "qz")]).alias("quat")) for r in roles])
    return wide.select("session_id", "row_id", "t_ms", F.explode(blocks).alias("b")).select("session_id", "row_id", "t_ms", "b.*")


def _anonymous(wide: DataFrame):
    """The last 21 columns as three blocks of seven."""
    names = wide.columns[-21:]
    if len(names) < 21:
        raise ValueError("no tracker blocks")
    keys = ("x", "y", "z", "qw", "qx", "qy", "qz")
    renamed = wide.withColumnsRenamed({n: f"block{i // 7}_{keys[i % 7]}" for i, n in enumerate(names)})
    return renamed, ["0", "1", "2"], lambda r: f"block{r}_"


def read_gripper(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """session_id, side, row_id, t_ms, opening_mm, angle_deg, sw; rows without time or opening go."""
    wide = with_time_ms(read_csv(spark, paths, required=["opening_mm"]))
    wide = numeric(wide, ["opening_mm", "angle_deg"])
    side = F.regexp_extract("path", r"gripper_(left|right)", 1)
    more = [c if c in wide.columns else F.lit(None).cast(t).alias(c) for c, t in (("angle_deg", "double"), ("sw", "string"))]
    return wide.where("t_ms is not null and opening_mm is not null").select("session_id", side.alias("side"), "row_id", "t_ms", "opening_mm", *more)


def read_frames(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """session_id, camera, row_id, index, t_ms of frame files; broken lines go; file order stays in row_id."""
    lines = read_lines(spark, paths)
    rows = lines.select("session_id", "row_id", F.regexp_extract("path", r"([^/]+)\.jsonl$", 1).alias("camera"), F.from_json("line", FRAME, {"mode": "PERMISSIVE"}).alias("f"))
    t = F.coalesce("f.capture_time", F.col("f.capture_timestamp_sec") * 1000)
    return rows.select("session_id", "camera", "row_id", F.coalesce("f.index", "f.frame_index").alias("index"), t.alias("t_ms")).where("index is not null and t_ms is not null")


def last_per_index(frames: DataFrame) -> DataFrame:
    """A repeated frame number keeps its last line."""
    return frames.groupBy("session_id", "camera", "index").agg(F.max_by("t_ms", "row_id").alias("t_ms"))


def read_flux(spark: SparkSession, paths: str | Sequence[str], columns: dict[str, float]) -> DataFrame:
    """Camera motion tables as one signal: the weighted sum of ``columns``; t_ms from timestamp_abs_ms or time_seconds."""
    wide = read_csv(spark, paths)
    there = {c: w for c, w in columns.items() if c in wide.columns}
    if not there:
        raise ValueError("none of the signal columns is there")
    wide = numeric(wide, [*there, "timestamp_abs_ms", "time_seconds"])
    t = F.coalesce(*[F.col(c) * f for c, f in (("timestamp_abs_ms", 1), ("time_seconds", 1000)) if c in wide.columns])
    value = None
    for c, w in there.items():
        value = F.col(c) * w if value is None else value + F.col(c) * w
    camera = F.regexp_extract("path", r"([^/]+)_flux\.csv$", 1)
    return wide.select("session_id", camera.alias("camera"), "row_id", t.alias("t_ms"), value.alias("value"))


def long_flux(*parts: tuple[DataFrame, str, str]) -> DataFrame:
    """Union of (frame, flux name column or literal, value column) into session_id, flux, row_id, t, value."""
    out = None
    for df, name, value in parts:
        flux = F.col(name) if name in df.columns else F.lit(name)
        p = df.select("session_id", flux.alias("flux"), "row_id", F.col("t_ms").alias("t"), F.col(value).cast("double").alias("value"))
        out = p if out is None else out.unionByName(p)
    return out


def read_metadata(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row for each metadata.json, with session_id from the folder when the document has none."""
    whole = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.from_json("value", METADATA).alias("m"))
    return whole.select("path", F.coalesce("m.session_id", F.regexp_extract("path", SESSION, 1)).alias("session_id"), *[F.col(f"m.{f}") for f in ("operator", "scenario", "start_time_ns", "end_time_ns", "trigger_time_ns", "duration_seconds", "failed", "check_score", "check_grade", "cameras", "trackers", "grippers")])


def read_episodes(spark: SparkSession, root: str, columns: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Rows, first, last and duration of each file of an episode dataset; only the needed columns are read."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(f"{root}/data").select(*columns, F.col("_metadata.file_path").alias("path"))
    return df.groupBy("path").agg(F.count("*").alias("n_rows"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last")).withColumn("duration", F.col("last") - F.col("first"))


def list_files(spark: SparkSession, root: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """path, size and modification time of files, without their content."""
    r = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    return (r.option("recursiveFileLookup", True) if recursive else r).load(root).select("path", F.col("length").alias("size"), "modificationTime")


def list_sessions(spark: SparkSession, root: str, date: str = "") -> DataFrame:
    """Session folders that hold a metadata.json: newest name first; names that begin with ``_`` or ``.`` or hold ``__FAILED`` go."""
    files = list_files(spark, root, "metadata.json")
    name = F.regexp_extract("path", SESSION, 1)
    s = files.select(name.alias("session_id"), F.regexp_replace("path", "/metadata.json$", "").alias("path")).distinct()
    return s.where(~F.col("session_id").rlike("^[_.]|__FAILED") & F.col("session_id").contains(date)).orderBy(F.desc("session_id"))


def page(df: DataFrame, order: Sequence, offset: int, limit: int) -> tuple[DataFrame, bool]:
    """One page of ordered rows, and whether there are more."""
    rows = df.orderBy(*order).offset(offset).limit(limit + 1)
    return rows.limit(limit), rows.count() > limit


def is_backup(path: str = "path"):
    return F.col(path).rlike(r"(?i)\.(bak|backup|orig)(\.|$)|_backup|/backups?/")


def stable_sessions(files: DataFrame, quiet_seconds: float, now: str = "current_timestamp()") -> DataFrame:
    """Sessions none of whose files changed for a while, without partial files."""
    own = files.withColumn("session_id", F.regexp_extract("path", r"/([^/]+)/(?:[a-z]+/)?[^/]+$", 1))
    s = own.groupBy("session_id").agg(F.max("modificationTime").alias("last"), F.bool_or(F.col("path").endswith(".part")).alias("partial"))
    return s.where(~F.col("partial") & (F.unix_timestamp(F.expr(now)) - F.unix_timestamp("last") >= quiet_seconds)).select("session_id", "last")


def missing_files(files: DataFrame, required: Sequence[str], sessions: DataFrame) -> DataFrame:
    """session_id and name of each required file that is not there."""
    want = sessions.select("session_id").withColumn("name", F.explode(F.array(*map(F.lit, required))))
    have = files.select(F.regexp_extract("path", r"/([^/]+)/(?:(?:videos|cameras|sensors)/)?[^/]+$", 1).alias("session_id"), F.regexp_extract("path", r"((?:(?:videos|cameras|sensors)/)?[^/]+)$", 1).alias("name"))
    return want.join(have, ["session_id", "name"], "left_anti")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def time_columns(df: DataFrame) -> list[str]:
    known = {n for n, _ in TIME_COLUMNS} | {"timestamp", "capture_time", "capture_timestamp_sec", "host_time_sec"}
    return [c for c in df.columns if c in known]


def decoded(spark: SparkSession, paths: str, decoder, schema: str, pattern: str = "*.mp4") -> DataFrame:
    """Rows that ``decoder(path, bytes)`` yields for each video file, one file a task step; the decoder is the caller's."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(paths).select("path", "content")

    def run(batches):
        import pandas as pd

        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                yield pd.DataFrame(decoder(path, content))

    return files.mapInPandas(run, schema)
