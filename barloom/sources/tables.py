"""Scans and sinks: ticks, bars, news and documents as DataFrames with declared schemas."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.session import counted_cut, cut

BAR = "timestamp timestamp_ntz, open double, high double, low double, close double, volume double, vwap double, transactions bigint"
DOCUMENT = "ticker string, date string, news array<struct<timestamp_et:string,text:string,url:string>>, per_hour_data map<string,map<string,double>>"
#: Folder of files that are being written.
ASIDE = "_aside"
PRICES = ["open", "high", "low", "close", "vwap", "volume", "transactions"]
# fixed values: accepted names of the granularities
GRANULARITIES = {
    "minute": ("minute", "min", "m"),
    "hour": ("hour", "hourly", "hr", "h"),
    "day": ("day", "daily", "d"),
    "week": ("week", "weekly", "w"),
    "month": ("month", "monthly", "mo"),
    "quarter": ("quarter", "quarterly", "q"),
    "year": ("year", "yearly", "annual", "annually", "y"),
}
#: Seconds of the units of fixed length, months of the others.
SECONDS = {"minute": 60, "hour": 3600, "day": 86_400, "week": 7 * 86_400}
MONTHS = {"month": 1, "quarter": 3, "year": 12}


def granularity(name: str) -> str:
    for unit, names in GRANULARITIES.items():
        if name.strip().lower() in names:
            return unit
    raise ValueError(f"unknown granularity {name!r}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ticker, ts, seq, price, size of the event stream."""
    size = F.get_json_object("props", "$.k").cast("double")
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("ticker"), "ts", F.col("event_id").alias("seq"), F.col("value").alias("price"), size.alias("size"))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as day-stamped ticks; the order in a day is the whole key."""
    seq = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("ticker"), F.col("l_shipdate").alias("ts"), seq.alias("seq"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_quantity").alias("size"))


def prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as prints inside the regular session of twenty days, few on the first and ever more later.

    The days pass the change to summer time; late days fill nearly every minute, early ones leave long gaps.
    """
    day = F.floor(F.sqrt(F.col("l_orderkey") % 400)).cast("int")
    minute = ((F.col("l_partkey") * 31 + F.col("l_suppkey") * 7 + F.col("l_linenumber") * 101) % 390).cast("int")
    ts = F.lit("2024-03-04 09:30:00").cast("timestamp_ntz") + F.make_dt_interval(days=day, mins=minute)
    seq = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("ticker"), ts.alias("ts"), seq.alias("seq"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_quantity").alias("size"))


def bucket(ts: Column, unit: str, multiplier: int = 1, origin: str = "1970-01-01", at_open: bool = False) -> Column:
    """The start of the bar of ``multiplier`` units that ``ts`` falls in.

    Bars of several units are counted from ``origin``: weeks from the Monday of its week, months, quarters and years
    from the start of its month, quarter or year. With ``at_open`` minutes and hours are counted from 09:30 of each
    day, so that the first bar starts with the session; what comes before falls into bars that end there.
    """
    unit = granularity(unit)
    start = F.lit(origin).cast("timestamp_ntz")
    if unit in MONTHS:
        first = F.date_trunc(unit, start).cast("timestamp_ntz")
        whole = (F.year(ts) - F.year(first)) * 12 + F.month(ts) - F.month(first)
        step = MONTHS[unit] * multiplier
        return first + F.make_ym_interval(months=(F.floor(whole / step) * step).cast("int"))
    if unit in ("minute", "hour") and at_open:
        start = F.to_date(ts).cast("timestamp_ntz") + F.expr("interval 570 minutes")
    elif unit == "week":
        start = F.date_trunc("week", start).cast("timestamp_ntz")
    elif multiplier == 1:
        return F.date_trunc(unit, ts).cast("timestamp_ntz")
    step = SECONDS[unit] * multiplier
    seconds = F.timestamp_diff("SECOND", start, F.date_trunc("second", ts).cast("timestamp_ntz"))
    return F.timestamp_add("SECOND", F.floor(seconds / step) * step, start).cast("timestamp_ntz")


def build_bars(ticks: DataFrame, unit: str, multiplier: int = 1, origin: str = "1970-01-01", at_open: bool = False) -> DataFrame:
    """OHLCV bars: one partial aggregate and one shuffle on (ticker, bucket)."""
    start = bucket(F.col("ts"), unit, multiplier, origin, at_open)
    at = F.struct("ts", "seq")
    sold = F.sum("size")
    return ticks.groupBy("ticker", start.alias("ts")).agg(
        F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"),
        sold.alias("volume"), F.try_divide(F.sum(F.col("price") * F.col("size")), F.nullif(sold, F.lit(0.0))).alias("vwap"), F.count(F.lit(1)).alias("transactions"),
    )


def first_present(df: DataFrame, *names: str) -> Column:
    """The first non-null of those columns that exist."""
    found = [F.col(n) for n in names if n in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("double")


def file_stem() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.[^./]+$", 1)


def read_bars(spark: SparkSession, path: str, schema: str = BAR) -> DataFrame:
    """One CSV per ticker; the ticker is the file's name, dots and all."""
    rows = spark.read.schema(schema).csv(path, header=True, pathGlobFilter="*.csv")
    return rows.select(file_stem().alias("ticker"), F.col("timestamp").alias("ts"), *[c for c in rows.columns if c != "timestamp"])


def locate(spark: SparkSession, root: str, ticker: str) -> str:
    """The file ``ticker``.csv under ``root``, else the first whose name starts with the ticker."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"{ticker}*.csv").load(root).select("path")
    exact = F.col("path").endswith(f"/{ticker}.csv")
    first = found.orderBy(exact.desc(), "path").first()
    if first is None:
        raise FileNotFoundError(f"{root}/{ticker}*.csv")
    return first.path


def locate_all(tickers: DataFrame, root: str) -> DataFrame:
    """(ticker, path): the file of every ticker as ``locate`` finds it, null where there is none.

    Names meet tickers by equality with each of their beginnings, so one listing and one join serve all tickers.
    """
    found = tickers.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(root).select("path")
    stem = F.regexp_extract("path", r"([^/]+)\.csv$", 1)
    starts = F.transform(F.sequence(F.lit(1), F.length("stem")), lambda n: F.substring("stem", F.lit(1), n))
    rows = found.withColumn("stem", stem).where("stem <> ''").select("path", "stem", F.explode(starts).alias("start"))
    best = rows.groupBy("start").agg(F.min_by("path", F.struct(F.col("start") != F.col("stem"), F.col("path"))).alias("path"))
    return tickers.select("ticker").distinct().join(best, safe_path(F.col("ticker")) == F.col("start"), "left").select("ticker", "path")


#: The inside of a quoted field up to its closing quote; doubled quotes belong to it. Possessive, so long ones need no deep stack.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'


def _unmarked() -> Column:
    return F.regexp_replace("value", "^\ufeff", "")


def _left_open(line: Column) -> Column:
    """Whether a quoted field is open at the end of ``line``, whose fields all start with a comma."""
    return F.regexp_replace(line, rf'\G,(?:"{_INSIDE}"[^,]*+|[^",][^,]*+|(?=,|\z))', "") != ""


def _records(lines: DataFrame) -> DataFrame:
    """(ticker, line): the lines (ticker, file, block, value) of a scan joined to records wherever a line feed is quoted.

    A line ends inside a quoted field or not, depending on how it starts: it keeps that, turns it over or fixes it. So
    blocks of a file are summed up alone, how each starts follows from the summaries before it, and no row or task
    holds a file. Lines are written once, so that what is numbered stays in place; only their states are sorted. A
    quote that is never closed runs to the end of its file, as in Python's csv module.
    """
    closing = rf'\A{_INSIDE}"[^,]*+'

    def states(value: Column) -> Column:
        """Whether a quoted field is open at the end of the line, if none is (a) or one is (b) at its start."""
        inside = ~value.rlike(closing) | _left_open(F.regexp_replace(value, closing, ""))
        return F.struct(_left_open(F.concat(F.lit(","), value)).alias("a"), inside.alias("b"))

    marked = F.col("value").startswith("\ufeff")
    lines = lines.withColumns({"at": F.monotonically_increasing_id(), "as_is": states(F.col("value")), "unmarked": F.when(marked, states(_unmarked()))})
    whole = cut(lines, "lines")
    w = W.partitionBy("file", "block").orderBy("at")
    before = w.rowsBetween(W.unboundedPreceding, -1)
    lines = whole.select("file", "block", "at", "as_is", "unmarked", F.row_number().over(w).alias("n"))
    first = (F.col("block") == 0) & (F.col("n") == 1)
    lines = lines.withColumn("s", F.when(first & F.col("unmarked").isNotNull(), F.col("unmarked")).otherwise(F.col("as_is")))
    lines = lines.select("file", "block", "at", "n", "s.a", "s.b")
    turns = F.coalesce(F.sum((F.col("a") & ~F.col("b")).cast("int")).over(before), F.lit(0)) % 2
    lines = lines.withColumn("turns", turns)
    # what the last line that fixes the state would have been at the start of the block, for the turns since
    fixed = F.when(F.col("a") == F.col("b"), F.col("a").cast("int").bitwiseXOR(F.col("turns")))
    lines = lines.withColumn("fixed", F.last(fixed, ignorenulls=True).over(before))

    def start(state: Column) -> Column:
        return F.coalesce("fixed", state).bitwiseXOR(F.col("turns"))

    def end(state: int) -> Column:
        return F.when(start(F.lit(state)) == 1, F.col("b")).otherwise(F.col("a")).cast("int")

    def last_start(state: int) -> Column:
        return F.max(F.when(start(F.lit(state)) == 0, F.col("n")))

    ends = [F.max_by(end(k), "n").alias(f"end{k}") for k in (0, 1)]
    blocks = lines.groupBy("file", "block").agg(*ends, *(last_start(k).alias(f"last{k}") for k in (0, 1)))
    in_file = W.partitionBy("file").orderBy("block")
    ahead = in_file.rowsBetween(W.unboundedPreceding, -1)
    turns = F.coalesce(F.sum((F.col("end0") > F.col("end1")).cast("int")).over(ahead), F.lit(0)) % 2
    blocks = blocks.withColumn("turns", turns)
    fixed = F.when(F.col("end0") == F.col("end1"), F.col("end0").bitwiseXOR(F.col("turns")))
    state = F.coalesce(F.last(fixed, ignorenulls=True).over(ahead), F.lit(0)).bitwiseXOR(F.col("turns"))
    blocks = blocks.withColumn("state", state)
    last = F.when(F.col("state") == 0, F.col("last0")).otherwise(F.col("last1"))
    open_record = F.last(F.when(last.isNotNull(), F.struct("block", last.alias("n"))), ignorenulls=True).over(ahead)
    blocks = blocks.select("file", "block", "state", open_record.alias("open"))

    lines = lines.join(blocks, ["file", "block"])
    here = F.when(start(F.col("state")) == 0, F.struct("block", "n"))
    record = F.coalesce(F.last(here, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)), F.col("open"))
    rows = whole.select("ticker", "file", "block", "at", "value").join(lines.select("file", "block", "at", "n", record.alias("record")), ["file", "block", "at"])
    value = F.when((F.col("block") == 0) & (F.col("n") == 1), _unmarked()).otherwise(F.col("value"))
    rows = rows.select("ticker", "file", "record", F.struct("block", "n", value.alias("value")).alias("part"))
    parts = F.transform(F.sort_array(F.collect_list("part")), lambda x: x["value"])
    return rows.groupBy("ticker", "file", "record").agg(F.array_join(parts, "\n").alias("line"))


def read_news(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """timestamp, url, text of comma-separated files; commas after the second belong to the text.

    Quoted fields may hold commas and doubled quotes, with ``multiline`` also line feeds. A leading mark of byte order,
    blank lines and header lines go; bytes that are no UTF-8 are replaced.
    """
    if multiline:
        place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
        rows = _records(spark.read.text(path, lineSep="\n").select(file_stem().alias("ticker"), *place, "value"))
    else:
        rows = spark.read.text(path).select(file_stem().alias("ticker"), _unmarked().alias("line"))
    # a quote that is never closed: only in whole records is that known
    end = r"|\z" if multiline else ""
    field = rf'(?:"{_INSIDE}(?:"[^,]*+{end})|[^,]*+)'

    def plain(c: Column) -> Column:
        inside, after = (F.regexp_extract(c, rf'\A"({_INSIDE})(?:"([^,]*+){end})\z', k) for k in (1, 2))
        return F.when(c.rlike(rf'\A"{_INSIDE}(?:"{end})'), F.concat(F.replace(inside, F.lit('""'), F.lit('"')), after)).otherwise(c)

    cells = F.transform(F.regexp_extract_all(F.concat(F.lit(","), "line"), F.lit(f",({field})"), F.lit(1)), plain)
    rows = rows.where(F.trim("line") != "").select("ticker", cells.alias("c"))
    rest = F.array_join(F.slice("c", 3, F.greatest(F.size("c"), F.lit(1))), ",")
    rows = rows.select("ticker", F.trim(F.get("c", F.lit(0))).alias("timestamp"), F.trim(F.coalesce(F.get("c", F.lit(1)), F.lit(""))).alias("url"), F.trim(rest).alias("text"))
    header = F.contains(F.lower("timestamp"), F.lit("timestamp")) & F.contains(F.lower(F.concat_ws(" ", "url", "text")), F.lit("url"))
    return rows.where(~header & (F.concat("timestamp", "url", "text") != ""))


DIVIDENDS = "cash_amount double, currency string, declaration_date date, dividend_type string, ex_dividend_date date, frequency int, id string, pay_date date, record_date date, ticker string"
SPLITS = "execution_date date, id string, split_from double, split_to double, ticker string"


def read_listing(spark: SparkSession, path: str, schema: str, limit: int | None = None) -> DataFrame:
    """A table of corporate events (DIVIDENDS, SPLITS) from CSV files, the first ``limit`` by id where one is given."""
    rows = spark.read.schema(schema).csv(path, header=True, pathGlobFilter="*.csv")
    return rows.orderBy("id").limit(limit) if limit else rows


def latest_of(df: DataFrame, key: str, order: list[str], keys: list[str] | None = None) -> DataFrame:
    """The last row of each key by ``order``, of a list of keys where one is given."""
    rows = df.where(F.col(key).isin(keys)) if keys else df
    best = rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in df.columns if c != key]), F.struct(*order)).alias("r"))
    return best.select(key, "r.*")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON documents of a tree with their size and time; what cannot be parsed keeps nulls."""
    rows = spark.read.schema(DOCUMENT).json(path, multiLine=True, recursiveFileLookup=True, pathGlobFilter="*.{json,txt}", mode="PERMISSIVE")
    return rows.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("mtime"))


def read_documents_checked(spark: SparkSession, path: str) -> DataFrame:
    """read_documents for input that may be broken: every file is a row, and ``reason`` says why it cannot be used.

    A file that is not UTF-8, is no JSON document, or has no ticker has its reason and null fields; the others have
    a null reason. Files without a byte are left out by the scan itself. Both kinds stand in one scan, so whoever
    writes the good rows can write and count the others beside them.
    """
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{json,txt}").load(path)
    text = F.col("content").cast("string")
    valid = F.is_valid_utf8(text)
    told = F.from_json(F.when(valid, text), DOCUMENT + ", _corrupt string", {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"})
    rows = rows.select(F.col("path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime"), valid.alias("valid"), told.alias("d"))
    no_document = F.col("d").isNull() | F.col("d._corrupt").isNotNull()
    reason = F.when(~F.col("valid"), "not UTF-8").when(no_document, "not a JSON document").when(F.col("d.ticker").isNull(), "no ticker")
    rows = rows.withColumn("reason", reason)
    fields = [F.when(F.col("reason").isNull(), F.col(f"d.{c}")).alias(c) for c in ("ticker", "date", "news", "per_hour_data")]
    return rows.select(*fields, "file", "size", "mtime", "reason")


def write_series(df: DataFrame, path: str, *parts: str) -> None:
    """Parquet by ``parts`` (ticker first), in time order."""
    order = [c for c in ("win_end", "day_id", "ts") if c in df.columns][:1]
    df.repartition(*parts).sortWithinPartitions(*parts, *order).write.mode("overwrite").partitionBy(*parts).parquet(path)


def write_features(df: DataFrame, root: str, kind: str, sampling: str, cadence: str) -> None:
    """Feature rows of each ticker under kind (agg, fft or cwt) and sampling, then cadence, in time order."""
    made = df.withColumns({"kind": F.lit(f"{kind}_{sampling}"), "cadence": F.lit(cadence)})
    write_series(made, root, "ticker", "kind", "cadence")


def write_quality(df: DataFrame, root: str) -> None:
    """What return_quality gives, beside the merged grid."""
    write_series(df, f"{root.rstrip('/')}/_qc", "ticker")


def write_csv_by_name(df: DataFrame, root: str, key: str = "ticker", order: str = "ts") -> None:
    """<root>/<key>.csv with a header for each key, rows in ``order``.

    Spark writes a folder for each key; then each file takes its name, one rename for each key.
    """
    spark = df.sparkSession
    made = f"{root.rstrip('/')}/_made"
    df.withColumn("__folder", safe_path(F.col(key))).drop(key).repartition("__folder").sortWithinPartitions("__folder", order).write.partitionBy("__folder").csv(made, header=True)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(made).getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in fs.listStatus(path(made)):
        name = folder.getPath().getName()
        if folder.isDirectory() and name.startswith("__folder="):
            for file in fs.listStatus(folder.getPath()):
                if file.getPath().getName().endswith(".csv"):
                    fs.rename(file.getPath(), path(f"{root}/{name.removeprefix('__folder=')}.csv"))
    fs.delete(path(made), True)


def write_csv_named(df: DataFrame, root: str, name: str, order: str) -> None:
    """<root>/<name>.csv, the fixed file of a small summary: all rows in one file, so in one task."""
    write_csv_by_name(df.withColumn("__name", F.lit(name)), root, "__name", order)


def safe_path(name: Column) -> Column:
    return F.translate(name, "/\\ ", "__")


def safe_name(ticker: Column) -> Column:
    return F.replace(F.translate(ticker, "/\\.", "___"), F.lit(" "), F.lit(""))


def write_documents(df: DataFrame, path: str) -> None:
    """One indented JSON document for each (ticker, day), in a folder of its own whose name is safe in a path."""
    body = F.to_json(F.struct("ticker", "date", "news", "per_hour_data"), {"pretty": "true"})
    rows = df.select(safe_name(F.col("ticker")).alias("folder"), F.col("date").alias("day"), body.alias("value"))
    rows.repartition("folder", "day").write.mode("overwrite").partitionBy("folder", "day").text(path)


def write_mirrored(df: DataFrame, path: str) -> None:
    """Documents of read_documents under ``path``, in the two folders (ticker, then day) that their ``file`` stands in."""
    body = F.to_json(F.struct("ticker", "date", "news", "per_hour_data"), {"pretty": "true"})
    level = lambda k: F.element_at(F.split(F.regexp_extract("file", "([^/]*)/([^/]*)/[^/]*$", k), "="), -1)
    df.select(level(1).alias("folder"), level(2).alias("day"), body.alias("value")).write.mode("overwrite").partitionBy("folder", "day").text(path)


def write_named(df: DataFrame, root: str) -> int:
    """Writes each row (path, value as bytes) to the file ``path`` under ``root``, from the tasks; how many there are.

    A task writes a file aside and moves it to its name, so a retried task or a second attempt leaves whole files and
    the same ones. Paths must be distinct. The file system must be one that pyarrow reaches from the executors.
    """
    root = root.rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pyarrow.fs.FileSystem.from_uri(root)
        fs.create_dir(f"{base}/{ASIDE}", recursive=True)
        made: set[str] = set()
        for batch in batches:
            for path, value in zip(batch.column("path").to_pylist(), batch.column("value").to_pylist()):
                target, aside = f"{base}/{path}", f"{base}/{ASIDE}/{uuid.uuid4().hex}"
                if (folder := target.rpartition("/")[0]) not in made:
                    fs.create_dir(folder, recursive=True)
                    made.add(folder)
                with fs.open_output_stream(aside) as f:
                    f.write(value)
                fs.move(aside, target)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    n = df.select("path", F.col("value").cast("binary").alias("value")).mapInArrow(run, "n bigint").agg(F.sum("n")).first()[0] or 0
    spark = df.sparkSession
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{ASIDE}")
    aside.getFileSystem(spark._jsc.hadoopConfiguration()).delete(aside, True)
    return n


def write_documents_named(df: DataFrame, root: str) -> int:
    """<root>/<ticker>/<date>_<ticker>.json for each document, indented."""
    body = F.to_json(F.struct("ticker", "date", "news", "per_hour_data"), {"pretty": "true"})
    name = F.concat(safe_name(F.col("ticker")), F.lit("/"), F.col("date").cast("string"), F.lit("_"), safe_path(F.col("ticker")), F.lit(".json"))
    return write_named(df.select(name.alias("path"), body.alias("value")), root)


def write_mirrored_named(df: DataFrame, root: str) -> int:
    """Documents of read_documents under ``root``, with the folder and the name that their ``file`` has."""
    body = F.to_json(F.struct("ticker", "date", "news", "per_hour_data"), {"pretty": "true"})
    return write_named(df.select(F.regexp_extract("file", "([^/]*/[^/]*)$", 1).alias("path"), body.alias("value")), root)


def write_if_better(df: DataFrame, root: str, part: str, keys: list[str], *rank: Column) -> int:
    """Merges ``df`` into the table under ``root``: a row replaces that of its key only where it ranks before it.

    ``rank`` orders the rows of a key, best first; what stands there wins ties. Only partitions (by ``part``) with a
    new row are written, each swapped as a whole when all are written. How many rows are new or replaced comes back;
    with none, no file changes.
    """
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    rows = df.withColumn("__new", F.lit(1))
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        there = spark.read.schema(df.schema).option("basePath", root).parquet(root)
        rows = rows.unionByName(there.withColumn("__new", F.lit(0)))
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*rank, "__new"))
    best, _ = counted_cut(rows.withColumn("__place", place).where("__place = 1").drop("__place"), "best")
    changed = best.where("__new = 1").groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    if not (n := changed.agg(F.sum("n")).first()[0]):
        return 0
    best = best.join(changed.select(part), part, "left_semi").drop("__new")
    best.repartition(part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(root)
    return n


def with_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast("double") for c in columns if c not in df.columns})


def keep_present(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    if lost := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(lost)}")
    return df
