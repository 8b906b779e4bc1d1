"""Reading and writing tables, and choosing files by the period in their name."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import c, nan_to_null

# How a period is written in a file name or a bound, with the months in one.
PERIODS = [(r"(?i)(\d{4})[-_]?Q(\d)", 3), (r"(\d{4})[-_]?(\d{2})", 1)]
FORMATS = {".csv": "csv", ".parquet": "parquet", ".json": "json"}


def format_of(path):
    """The Spark format for a path's extension; a path without one is Parquet."""
    name = path.rstrip("/").rsplit("/", 1)[-1].lower()
    if "." not in name:
        return "parquet"
    suffix = name[name.rindex(".") :]
    if suffix not in FORMATS:
        raise ValueError(f"Unsupported file format: {suffix}")
    return FORMATS[suffix]


def _file_system(spark, path):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path


def exists(spark, path):
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def list_names(spark, folder):
    """Names of the direct children of ``folder``; temporary ones (``~``, ``.``, ``_``) left out."""
    fs, p = _file_system(spark, folder)
    if not fs.exists(p):
        raise FileNotFoundError(f"No such folder: {folder}")
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n for n in names if not n.startswith(("~", ".", "_")))


def read_table(spark, path, schema=None):
    """Read CSV (with header), JSON or Parquet; NaN becomes null.

    Pass ``schema`` for large CSV or JSON input: it saves the extra inference pass.
    """
    fmt = format_of(path)
    if not exists(spark, path):
        raise FileNotFoundError(f"No such file: {path}")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", schema is None)
    if schema is not None:
        reader = reader.schema(schema)
    return nan_to_null(reader.load(path))


def write_table(df, path, mode="overwrite"):
    """Write a directory in the format of the extension."""
    fmt = format_of(path)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    return path


def latest_pair(spark, folder, raw_name=None):
    """Paths of the last train/test pair by name, optionally of one raw file only."""
    base = None
    if raw_name:
        base = raw_name.replace("\\", "/").rsplit("/", 1)[-1]
        base = base.rsplit(".", 1)[0] if "." in base else base
    names = list_names(spark, folder)
    picked = []
    for part in ("train", "test"):
        suffix = f"_{part}.parquet"
        fits = [n for n in names if (n == base + suffix if base else n.endswith(suffix))]
        if not fits:
            raise FileNotFoundError(f"No {part} table in {folder}" + (f" for {raw_name}" if raw_name else ""))
        picked.append(f"{folder.rstrip('/')}/{fits[-1]}")
    return tuple(picked)


def period_of(text):
    """Struct of the first and last month (counted from year 0) of the period in ``text``; null without one.

    The rules are tried in order; a month has to lie in a year, else ``text`` counts as undated.
    """
    def by(pattern, months):
        year, n = (F.regexp_extract(text, pattern, i).try_cast("int") for i in (1, 2))
        last = year * 12 + n * months
        named = F.rlike(text, F.lit(pattern)) & (n * months <= 12) & (n > 0)
        return F.when(named, F.struct((last - months + 1).alias("first"), last.alias("last")))

    return F.coalesce(*[by(*rule) for rule in PERIODS])


def in_period(name, start=None, end=None):
    """Whether a name's period begins within the inclusive bounds; undated names and bounds always fit."""
    bound = lambda x: period_of(F.lit(x).cast("string"))
    begins = period_of(name)["first"]
    return F.coalesce(begins >= bound(start)["first"], F.lit(True)) & F.coalesce(begins <= bound(end)["last"], F.lit(True))


def names_in_period(spark, names, start=None, end=None):
    """The names of a folder's listing that :func:`in_period` keeps, sorted."""
    table = spark.createDataFrame([(n,) for n in names], "name string")
    return [r["name"] for r in table.where(in_period(F.col("name"), start, end)).orderBy("name").collect()]


def readable(name):
    """Whether a name is a table of a known format, or a folder of one."""
    return "=" in name or "." not in name or name[name.rindex(".") :].lower() in FORMATS


def read_period(spark, folder, start=None, end=None, schema=None):
    """Read only those children of ``folder`` (files, or one folder per month) in the period; files of other kinds are left."""
    names = names_in_period(spark, [n for n in list_names(spark, folder) if readable(n)], start, end)
    if not names:
        raise FileNotFoundError(f"No file of the period in {folder}")
    paths = [f"{folder.rstrip('/')}/{n}" for n in names]
    formats = {format_of(n) for n in names if "=" not in n} or {"parquet"}
    if len(formats) > 1:
        raise ValueError(f"Files of several formats in {folder}: {sorted(formats)}")
    fmt = formats.pop()
    reader = spark.read.format(fmt).option("basePath", folder)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", schema is None)
    if schema is not None:
        reader = reader.schema(schema)
    return nan_to_null(reader.load(paths))


def write_by_month(df, folder, date_column):
    """Write one folder per month, the layout ``read_period`` prunes by name.

    Rows are written where they are, without a shuffle by month: a month holding most
    of the table stays spread over many tasks.
    """
    df.withColumn("period", F.date_format(c(date_column), "yyyy-MM")).write.mode(
        "overwrite"
    ).partitionBy("period").parquet(folder)
    return folder
