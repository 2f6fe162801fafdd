"""Queries that write files and read them back, and queries of the tolerant readers and projections."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.series import number, rounded
from barloom.operators import calendar, documents, features, merge, spectral
from barloom.plans import spectra, sql
from barloom.plans.registry import register, simple
from barloom.session import cut, shared_dir
from barloom.sources import scans, tables

KEY = ["ticker", "ts"]
OHLC = ["open", "high", "low", "close", "volume", "vwap"]


def folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/barloom/{name}-{uuid.uuid4().hex}"


def csv_bars(spark: SparkSession, d: str) -> DataFrame:
    """Hour bars, written as one CSV for each ticker and scanned; the ticker is the file's name."""
    from barloom.plans.catalog import hour_bars

    root = folder(spark, "bars")
    bars = hour_bars(spark, d)
    tables.write_csv_by_name(bars.withColumnRenamed("ts", "timestamp").select("ticker", "timestamp", *OHLC, "transactions"), root, order="timestamp")
    return tables.read_bars(spark, root)


def news_lines(spark: SparkSession, d: str) -> DataFrame:
    """(source, line): news as comma-separated lines, every third one quoted, with line feeds, the others as they are."""
    docs = tables.table(spark, d, "documents").where("text is not null")
    url = F.concat(F.lit("doc:"), "doc_id")
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    bare = F.translate("text", '"\n\r', "   ")
    line = F.when(F.col("doc_id") % 3 == 0, F.concat_ws(",", F.lit("2024-01-02T03:04:05Z"), F.concat(F.lit('"'), url, F.lit('"')), quoted)).otherwise(
        F.concat_ws(",", F.lit(" 2024-01-02"), url, bare),
    )
    head = docs.select("source", F.lit("timestamp,url,text").alias("line")).distinct()
    return head.unionByName(docs.select("source", line.alias("line")))


def csv_news(spark: SparkSession, d: str) -> DataFrame:
    """News lines of every source, written and scanned with quoting; commas of the text are kept."""
    root = folder(spark, "news")
    news_lines(spark, d).withColumn("folder", tables.safe_path(F.col("source"))).drop("source").write.partitionBy("folder").text(root)
    return tables.read_news(spark, root, multiline=True).select("timestamp", "url", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def round_trip(write, read):
    """A query that writes what it has built under a new folder and reads it back."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        root = folder(spark, "files")
        write(spark, d, root)
        return read(spark, root)

    return run


def end_times(spark: SparkSession, d: str) -> DataFrame:
    """The end of the hour by each set of columns that says it."""
    from barloom.plans.catalog import hour_bars

    b = hour_bars(spark, d).select("ticker", F.col("ts").alias("t"))
    kinds = {c: b.select("ticker", F.col("t").alias(c)) for c in ("hour_end_ts", "win_end", "end_ts", "feature_ts", "timestamp", "time", "ts", "win_start", "hour_start_ts")}
    kinds["day_and_label"] = b.select("ticker", F.to_date("t").alias("day_id"), F.date_format("t", " H : mm").alias("hour_label"))
    out = None
    for kind, df in kinds.items():
        part = df.select("ticker", F.lit(kind).alias("kind"), calendar.end_of_hour(df).alias("end_ts"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("ticker", "kind").agg(F.min("end_ts").alias("first"), F.max("end_ts").alias("last"), F.count("end_ts").alias("n"))


def register_all() -> None:
    from barloom.plans import catalog

    # ---- scans
    simple("csv_bars", csv_bars, [*KEY, *OHLC, "transactions"], ["hour_bars"], "hour_bars", OHLC)
    said = "md5(CASE WHEN doc_id % 3 = 0 THEN trim(text, ' ') ELSE trim(translate(text, chr(34) || chr(10) || chr(13), '   '), ' ') END)"
    register(
        "csv_news",
        (
            "SELECT CASE WHEN doc_id % 3 = 0 THEN '2024-01-02T03:04:05Z' ELSE '2024-01-02' END AS timestamp, 'doc:' || doc_id AS url, "
            f"{said} AS text_md5 FROM documents WHERE text IS NOT NULL"
        ),
    )(
        csv_news,
    )
    loose = lambda s, d: catalog.hour_bars(s, d).withColumnsRenamed({"open": "o", "vwap": "vw"})
    simple(
        "loose_fields",
        lambda s, d: (lambda b: b.select(*KEY, *[tables.first_present(b, *c).alias(c[0]) for c in (("open", "o"), ("close", "c"), ("vwap", "vw"), ("extra", "x"))]))(loose(s, d)),
        [*KEY, "open", "close", "vwap", "extra"],
        ["hour_bars"],
        "hour_bars",
        ["open", "close", "vwap"],
        exprs={"extra": "NULL::DOUBLE"},
    )
    simple(
        "present_columns",
        lambda s, d: tables.require(tables.keep_present(tables.with_missing(catalog.hour_bars(s, d), ["atr_14", "close"]), [*KEY, "not_there", "close", "atr_14"]), ["atr_14"]),
        [*KEY, "close", "atr_14"],
        ["hour_bars"],
        "hour_bars",
        ["close"],
        exprs={"atr_14": "NULL::DOUBLE"},
    )
    dirty = "CASE l_linenumber % 4 WHEN 0 THEN 'n/a' WHEN 1 THEN 'inf' WHEN 2 THEN '' ELSE CAST(l_quantity AS {}) END"
    register("number_or_null", f"SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, l_linenumber, CASE WHEN isfinite(TRY_CAST({dirty.format('VARCHAR')} AS DOUBLE)) THEN TRY_CAST({dirty.format('VARCHAR')} AS DOUBLE) END AS x FROM lineitem")(
        lambda s, d: tables.table(s, d, "lineitem").select(F.col("l_orderkey").cast("bigint").alias("l_orderkey"), "l_linenumber", number(F.expr(dirty.format("STRING"))).alias("x"))
    )
    parts = "trim(concat_ws(' ', nullif(source, ''), nullif(CASE WHEN doc_id % 2 = 0 THEN '' ELSE lang END, ''), nullif(trim(text, ' '), '')), ' ')"
    register("news_between", sql.query(["news"], f"SELECT CAST(doc_id AS BIGINT) AS doc_id, {parts} AS said FROM documents WHERE doc_id IN (SELECT doc_id FROM news WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-03')"))(
        lambda s, d: calendar.between_days(catalog.news(s, d), "2024-01-01", "2024-01-02").join(tables.table(s, d, "documents").select("doc_id", "source", "lang"), "doc_id")
        .select("doc_id", documents.news_text(F.col("source"), F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.col("lang")), F.trim(F.col("text"))).alias("said"))
    )
    one = "SELECT event_type AS ticker, max(ts) AS ts, arg_max(value, (ts, event_id)) AS price FROM events WHERE event_type IN ('click', 'view') GROUP BY 1"
    register("snapshot_list", f"SELECT ticker, ts, round(price, 6) + 0.0 AS price FROM ({one})")(
        round_trip(
            lambda s, d, root: tables.write_series(tables.latest_of(tables.ticks(s, d).select("ticker", "ts", "seq", "price"), "ticker", ["ts", "seq"], ["click", "view"]), root, "ticker"),
            lambda s, root: rounded(s.read.parquet(root).select("ticker", "ts", "price")),
        )
    )
    extended = (
        "SELECT ticker, CAST(ts AS DATE) AS day_id, first(price ORDER BY ts, seq) FILTER (m BETWEEN 570 AND 959) AS open, last(price ORDER BY ts, seq) FILTER (m BETWEEN 570 AND 959) AS close, "
        "max(price) FILTER (m BETWEEN 570 AND 959) AS high, min(price) FILTER (m BETWEEN 570 AND 959) AS low, sum(size) AS volume, last(price ORDER BY ts, seq) FILTER (m >= 960) AS afterHours, "
        f"first(price ORDER BY ts, seq) FILTER (m < 570) AS preMarket FROM (SELECT *, {sql.MINUTE} AS m FROM ticks) GROUP BY 1, 2"
    )
    prices = ["open", "close", "high", "low", "volume", "afterHours", "preMarket"]
    register("open_close_extended", sql.query(["ticks"], extended, prices))(lambda s, d: rounded(features.open_close(tables.ticks(s, d))))
    paid = (
        "SELECT o_totalprice AS cash_amount, 'USD' AS currency, CAST(o_orderdate AS DATE) AS ex_dividend_date, CASE WHEN o_orderkey "
        "% 2 = 0 THEN 'CD' ELSE 'SC' END AS dividend_type, 4 AS frequency, 'E' || o_orderkey AS id, 'T' || o_custkey % 20 AS ticker "
        "FROM orders"
    )
    pick = ["cash_amount", "currency", "ex_dividend_date", "dividend_type", "frequency", "id", "ticker"]
    made = lambda s, d: tables.table(s, d, "orders").selectExpr("o_totalprice AS cash_amount", "'USD' AS currency", "CAST(o_orderdate AS DATE) AS ex_dividend_date", "IF(o_orderkey % 2 = 0, 'CD', 'SC') AS dividend_type", "4 AS frequency", "concat('E', o_orderkey) AS id", "concat('T', o_custkey % 20) AS ticker")
    every = [c.split()[0] for c in tables.DIVIDENDS.split(", ")]
    register("dividends", f"SELECT * REPLACE (round(cash_amount, 6) + 0.0 AS cash_amount) FROM ({paid})")(
        round_trip(
            lambda s, d, root: (lambda m: m.select(*[F.col(c) if c in pick else F.lit(None).cast("date").alias(c) for c in every]).write.csv(root, header=True))(made(s, d)),
            lambda s, root: rounded(tables.read_listing(s, root, tables.DIVIDENDS).select(*pick)),
        )
    )
    register("dividends_first", f"SELECT id, ticker FROM ({paid}) ORDER BY id LIMIT 1000")(
        round_trip(
            lambda s, d, root: (lambda m: m.select(*[F.col(c) if c in pick else F.lit(None).cast("date").alias(c) for c in every]).write.csv(root, header=True))(made(s, d)),
            lambda s, root: tables.read_listing(s, root, tables.DIVIDENDS, 1000).select("id", "ticker"),
        )
    )
    split = (
        "SELECT CAST(o_orderdate AS DATE) AS execution_date, 'S' || o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS split_from, "
        "CASE WHEN o_orderkey % 3 = 0 THEN 1.0::DOUBLE ELSE (2 + o_custkey % 4)::DOUBLE END AS split_to, 'T' || o_custkey % 20 AS ticker FROM orders"
    )
    divided = [
        "CAST(o_orderdate AS DATE) AS execution_date",
        "concat('S', o_orderkey) AS id",
        "IF(o_orderkey % 3 = 0, 2.0, 1.0) AS split_from",
        "IF(o_orderkey % 3 = 0, 1, 2 + o_custkey % 4) AS split_to",
        "concat('T', o_custkey % 20) AS ticker",
    ]
    register("splits", split)(
        round_trip(
            lambda s, d, root: tables.table(s, d, "orders").selectExpr(*divided).write.csv(root, header=True),
            lambda s, root: tables.read_listing(s, root, tables.SPLITS),
        )
    )

    def named_features(s: SparkSession, d: str) -> DataFrame:
        """The fixed files of the spectral summaries: features of a week and ridges of a month, each one CSV."""
        root = folder(s, "summaries")
        merged = cut(catalog.merged(s, d), "merged")
        made = spectral.wide(spectral.fft_windows(merged, ["r_close"], "week"), ["r_close"], ["pct_hi", "dom_period_bars"])
        tables.write_csv_named(rounded(made), root, "fft_daily", "win_end")
        made = spectral.wide(spectral.cwt_windows(merged, ["r_close"], "month"), ["r_close"], ["power_hi", "peak_ratio"])
        tables.write_csv_named(rounded(made), root, "cwt_daily", "win_end")
        tables.write_csv_named(rounded(spectra.ridges(merged)), root, "cwt_ridges", "win_end")
        out = None
        for name, columns in (("fft_daily", ["r_close_pct_hi", "r_close_dom_period_bars"]), ("cwt_daily", ["r_close_power_hi", "r_close_peak_ratio"]), ("cwt_ridges", ["avg_period", "max_power"])):
            rows = s.read.csv(f"{root}/{name}.csv", header=True).select("ticker", F.col("win_end").cast("timestamp_ntz").alias("win_end"), *(F.col(c).cast("double").alias(x) for c, x in zip(columns, "ab")))
            rows = rows.withColumn("file", F.lit(name))
            out = rows if out is None else out.unionByName(rows)
        return out

    week = spectra.wide(spectra.fft_windows("merged", ["r_close"], "week", 6), ["r_close"], ["pct_hi", "dom_period_bars"])
    grids, month = spectra.cwt_windows("merged", ["r_close"], "month", 6)
    month = spectra.wide(month, ["r_close"], ["power_hi", "peak_ratio"])
    three = (
        f"SELECT ticker, win_end, r_close_pct_hi AS a, r_close_dom_period_bars AS b, 'fft_daily' AS file FROM ({week}) "
        f"UNION ALL SELECT ticker, win_end, r_close_power_hi, r_close_peak_ratio, 'cwt_daily' FROM ({month}) "
        f"UNION ALL SELECT ticker, win_end, avg_period, max_power, 'cwt_ridges' FROM ({spectra.ridge_table('SELECT * FROM grid_r_close')})"
    )
    register("write_named_features", spectra.over_grids(grids, three, "merged", ["a", "b"]))(named_features)
    simple("end_times", end_times, ["ticker", "kind", "first", "last", "n"], ["hour_bars"], (
        "(SELECT ticker, kind, min(ts + to_hours(more)) AS first, max(ts + to_hours(more)) AS last, count(*)::BIGINT AS n FROM hour_bars, (VALUES ('hour_end_ts', 0), ('win_end', 0), ('end_ts', 0), ('feature_ts', 0), "
        "('timestamp', 0), ('time', 0), ('ts', 0), ('win_start', 1), ('hour_start_ts', 1), ('day_and_label', 1)) k(kind, more) GROUP BY 1, 2)"
    ))
    name = "CASE doc_id % 3 WHEN 0 THEN 'a/b/2024-01-05_' || source || '.json' WHEN 1 THEN 'a/2024-01-06/' || source || '.json' ELSE '2024-1-07_x.json' END"
    inner = "CASE WHEN doc_id % 2 = 0 THEN '2024-02-03' ELSE 'on 2024-02-04' END"
    register("document_dates", f"SELECT CAST(doc_id AS BIGINT) AS doc_id, coalesce(nullif(regexp_extract(split_part({name}, '/', -1), '^(\\d{{4}}-\\d{{2}}-\\d{{2}})_', 1), ''), CASE WHEN regexp_full_match({inner}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN {inner} END) AS date FROM documents")(
        lambda s, d: tables.table(s, d, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), documents.document_date(F.expr(name), F.expr(inner)).alias("date"))
    )

    # ---- sinks
    simple(
        "write_series",
        round_trip(lambda s, d, root: tables.write_series(catalog.hour_bars(s, d), root, "ticker"), lambda s, root: s.read.parquet(root)),
        [*KEY, "close"],
        ["hour_bars"],
        "hour_bars",
        ["close"],
    )
    days = spectra.reduced(catalog.daily_sql("m_cumulated"), "week", "median", ["rv"], 390)
    register("write_features", sql.query(["m_cumulated"], f"SELECT ticker, 'agg_minute' AS kind, 'week' AS cadence, win_end, days, rv FROM ({days})", ["rv"]))(
        round_trip(
            lambda s, d, root: tables.write_features(features.reduce_windows(features.daily(catalog.minute_grid(s, d)), "week", "median", "minute"), root, "agg", "minute", "week"),
            lambda s, root: rounded(s.read.parquet(root).select("ticker", "kind", "cadence", "win_end", "days", "rv")),
        )
    )
    register("write_quality", sql.query(["m_chosen"], f"SELECT * FROM {catalog.qc_sql}", ["rclose_valid_ratio"]))(
        round_trip(lambda s, d, root: tables.write_quality(merge.return_quality(catalog.minute_grid(s, d)), root), lambda s, root: rounded(s.read.parquet(f"{root}/_qc")))
    )
    best = (
        "SELECT source, lang, CAST(doc_id AS BIGINT) AS doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER "
        "BY (text LIKE '% %') DESC, n_chars DESC, doc_id % 7 DESC, doc_id) AS rn FROM documents) WHERE rn = 1"
    )
    def consolidated(s: SparkSession, d: str) -> DataFrame:
        """Documents in three rounds, the third with those of the first again; each round keeps what is better."""
        root = folder(s, "better")
        docs = tables.table(s, d, "documents")
        rank = [F.contains("text", F.lit(" ")).desc(), F.desc("n_chars"), (F.col("doc_id") % 7).desc(), "doc_id"]
        for part in (F.col("doc_id") % 3 == 0, F.col("doc_id") % 3 == 1, F.col("doc_id") % 3 != 1):
            tables.write_if_better(docs.where(part), root, "source", ["source", "lang"], *rank)
        return s.read.parquet(root).select("source", "lang", F.col("doc_id").cast("bigint").alias("doc_id"))

    register("write_if_better", best)(consolidated)
    winners = lambda s, d: documents.best_of(tables.table(s, d, "documents"), ["source", "lang"], F.contains("text", F.lit(" ")), F.col("n_chars"), F.col("doc_id") % 7, F.col("doc_id"))
    register("write_winners", best)(
        round_trip(
            lambda s, d, root: tables.write_series(winners(s, d).select("source", "lang", F.col("doc_id").cast("bigint").alias("doc_id")), root, "source"),
            lambda s, root: s.read.parquet(root).select("source", "lang", "doc_id"),
        ),
    )

    fixed = ["AGG_N", "valid_bars", "rv", "trend_persistence"]
    register("write_named_csv", sql.query(["m_cumulated"], f"SELECT ticker, day_id, {', '.join(fixed)} FROM ({catalog.daily_sql('m_cumulated')})", ["rv"]))(
        round_trip(
            lambda s, d, root: tables.write_csv_named(rounded(features.daily(catalog.minute_grid(s, d)).select("ticker", "day_id", *fixed)), root, "agg_daily", "day_id"),
            lambda s, root: s.read.schema("ticker string, day_id date, AGG_N bigint, valid_bars bigint, rv double, trend_persistence bigint").csv(f"{root}/agg_daily.csv", header=True),
        )
    )

    # ---- documents
    told = (
        "(SELECT ['click', 'view', 'purchase', 'cart', 'login', 'search', 'error', 'logout', 'signup'][1 + CAST(substr(ticker, 4) "
        "AS INTEGER) % 9] AS ticker, CAST(ts AS DATE)::VARCHAR AS date, count(*)::BIGINT AS n FROM news GROUP BY 1, 2)"
    )
    flat = (
        f"SELECT f.ticker, f.date, hour, key, value, n FROM ({catalog.flat_sql}) f JOIN {told} w ON f.ticker = w.ticker AND f.date "
        "= w.date WHERE value IS NOT NULL"
    )
    cells = lambda df: rounded(df.select("ticker", "date", F.size("news").cast("bigint").alias("n"), F.explode("per_hour_data").alias("hour", "m")).select("ticker", "date", "n", "hour", F.explode("m").alias("key", "value")))
    register("doc_assemble_flat", sql.query(["merged", "news"], flat, ["value"]))(lambda s, d: cells(catalog.assembled(s, d)))
    register("write_documents", sql.query(["merged", "news"], flat, ["value"]))(
        round_trip(lambda s, d, root: tables.write_documents(catalog.assembled(s, d), root), lambda s, root: cells(tables.read_documents(s, root)))
    )

    def mirrored(s: SparkSession, d: str) -> DataFrame:
        a, b = folder(s, "documents"), folder(s, "mirrored")
        tables.write_documents(catalog.assembled(s, d), a)
        left = documents.drop_empty(documents.drop_features(tables.read_documents(s, a)))
        tables.write_mirrored(left, b)
        made = tables.read_documents(s, b)
        where = F.regexp_extract("file", "folder=([^/]*)/day=([^/]*)/", 1)
        return cells(made.where(where == tables.safe_name(F.col("ticker"))))

    register("write_mirrored", sql.query(["merged", "news"], f"SELECT * FROM ({flat}) WHERE key NOT IN ('inter.close', 'inter.r_close')", ["value"]))(
        mirrored,
    )

    def named(s: SparkSession, d: str) -> DataFrame:
        """Documents under their names, read, without some features under the same names again, and read."""
        a, b = folder(s, "documents"), folder(s, "mirrored")
        tables.write_documents_named(catalog.assembled(s, d), a)
        tables.write_mirrored_named(documents.drop_empty(documents.drop_features(tables.read_documents(s, a))), b)
        made = tables.read_documents(s, b).withColumn("file", F.regexp_extract("file", "([^/]*/[^/]*)$", 1))
        cells = made.select("file", "ticker", "date", F.size("news").cast("bigint").alias("news"), F.explode("per_hour_data").alias("hour", "m"))
        cells = cells.select("file", "ticker", "date", "news", F.explode("m").alias("key", "value")).where("value is not null")
        return rounded(cells.groupBy("file", "ticker", "date", "news").agg(F.count(F.lit(1)).alias("cells"), F.sum("value").alias("total")))

    register(
        "write_documents_named",
        sql.query(
            ["merged", "news"],
            (
                "SELECT ticker || '/' || date || '_' || ticker || '.json' AS file, ticker, date::VARCHAR AS date, n AS news, count(*)::BIGINT AS cells, "
                f"sum(value) AS total FROM ({flat}) WHERE key NOT IN ('inter.close', 'inter.r_close') GROUP BY ALL"
            ),
            ["total"],
        ),
    )(named)

    def unreadable(s: SparkSession, d: str) -> DataFrame:
        """A document of each source and language, some cut off, some with a byte that is no UTF-8, some without a ticker."""
        root = folder(s, "broken")
        item = F.struct(F.lit("t").alias("timestamp_et"), F.coalesce("text", F.lit("")).alias("text"), F.col("doc_id").cast("string").alias("url"))
        of = tables.table(s, d, "documents").groupBy("source", "lang").agg(F.sort_array(F.collect_list(item)).alias("news"))
        ticker = F.when(~F.col("source").endswith("5"), F.col("source"))
        body = F.to_json(F.struct(ticker.alias("ticker"), F.col("lang").alias("date"), "news")).cast("binary")
        cut_off = F.substring(body, F.lit(1), F.octet_length(body) - 3)
        value = F.when(F.col("source").endswith("3"), cut_off).when(F.col("source").endswith("7"), F.concat(body, F.lit(b"\xff"))).otherwise(body)
        name = F.concat("source", F.lit("/"), "lang", F.lit(".json"))
        tables.write_named(of.select(name.alias("path"), value.alias("value")), root)
        made = tables.read_documents_checked(s, root)
        return made.select(F.regexp_extract("file", "([^/]*/[^/]*)$", 1).alias("file"), "ticker", F.col("date").alias("lang"), F.size("news").cast("bigint").alias("n"), "reason")

    register(
        "unreadable_documents",
        (
            "SELECT source || '/' || lang || '.json' AS file, CASE WHEN reason IS NULL THEN source END AS ticker, CASE WHEN reason IS NULL THEN lang END AS lang, "
            "CASE WHEN reason IS NULL THEN n END AS n, reason FROM (SELECT source, lang, count(*)::BIGINT AS n, CASE WHEN source LIKE '%3' THEN 'not a JSON document' "
            "WHEN source LIKE '%7' THEN 'not UTF-8' WHEN source LIKE '%5' THEN 'no ticker' END AS reason FROM documents GROUP BY 1, 2)"
        ),
    )(unreadable)
    twice = lambda s, d: catalog.merged(s, d).withColumn("end_ts", F.col("ts"))

    def last_rows(s: SparkSession, d: str) -> DataFrame:
        m = twice(s, d)
        first = m.select("ticker", "end_ts", F.lit(1).alias("seq"), F.col("close").alias("a"), F.col("volume").alias("b"))
        second = m.where("bar_index_since_open % 2 = 0").select(
            "ticker",
            "end_ts",
            F.lit(2).alias("seq"),
            F.lit(None).cast("double").alias("a"),
            (F.col("volume") + 1).alias("b"),
        )
        later = m.where("bar_index_since_open % 3 = 0").select(
            "ticker",
            "end_ts",
            F.lit(1).alias("seq"),
            F.lit(7.0).alias("a"),
            F.lit(None).cast("double").alias("b"),
        )
        rows = documents.long_features(first.unionByName(second), "x", ["a", "b"], 1).unionByName(documents.long_features(later, "x", ["a", "b"], 2))
        return rounded(documents.latest(rows).select("ticker", "end_ts", "key", "value"))

    kept = (
        "SELECT ticker, ts AS end_ts, unnest(['x.a', 'x.b']) AS key, unnest([CASE WHEN bar_index_since_open % 3 = 0 THEN 7.0 WHEN bar_index_since_open % 2 = 0 THEN NULL ELSE close END, "
        "CASE WHEN bar_index_since_open % 2 = 0 THEN volume + 1 ELSE volume END]) AS value FROM merged"
    )
    register("doc_last_rows", sql.query(["merged"], f"SELECT * FROM ({kept}) WHERE value IS NOT NULL", ["value"]))(last_rows)
    names, suffixes = ["r_close", "bb_bw_20", "absent"], ["pct_hi", "dom_period_bars", "nothing"]
    wide = spectra.wide(spectra.fft_windows("merged", ["r_close", "bb_bw_20"], "week", 6), ["r_close", "bb_bw_20"], suffixes[:2])
    columns = [f"{c}_{x}" for c in names[:2] for x in suffixes[:2]]
    long = (
        f"SELECT ticker, win_end AS end_ts, unnest([{', '.join(repr('fft.' + c) for c in columns)}]) AS key, unnest([{', '.join(columns)}]) "
        f"AS value FROM ({wide})"
    )
    register("series_features", sql.query(["merged"], long, ["value"]))(
        lambda s, d: rounded(documents.series_features(spectral.wide(spectral.fft_windows(catalog.merged(s, d), names[:2], "week"), names[:2], suffixes[:2]), "fft", names, suffixes, 1, "win_end").select("ticker", "end_ts", "key", "value"))
    )
    hour = "'  \"' || strftime(ts, '%H:%M') || '\": {\n    \"inter.transactions\": ' || transactions::DOUBLE || '\n  }'"
    prompt = (
        "'You are a financial market analyst.\nWrite a concise market commentary for ' || ticker || ' on ' || CAST(ts AS DATE)::VARCHAR || ' based on the intraday technical indicators below.\n\n<INTRADAY_DATA>\n{\n' "
        f"|| string_agg({hour}, ',\n' ORDER BY ts) || '\n}}\n</INTRADAY_DATA>\n\nCommentary:\n'"
    )
    register("commentary_prompts", sql.query(["hour_bars"], f"SELECT ticker, CAST(ts AS DATE)::VARCHAR AS date, md5({prompt}) AS prompt_md5 FROM hour_bars GROUP BY ticker, CAST(ts AS DATE)"))(
        lambda s, d: documents.per_hour(documents.long_features(catalog.hour_bars(s, d), "inter", ["transactions"], 1, "ts"))
        .select("ticker", F.col("date").cast("string").alias("date"), F.md5(documents.commentary_prompt(F.col("ticker"), F.col("date").cast("string"), F.col("per_hour_data")).cast("binary")).alias("prompt_md5"))
    )

    def answers(s: SparkSession, d: str) -> DataFrame:
        rows = tables.table(s, d, "documents").where("text is not null").select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.concat(F.lit("P"), "doc_id").alias("prompt"),
        )
        said = documents.run_model(rows, "prompt", "answer", lambda: lambda prompts: [f"{p}  says {len(p)} " if len(p) % 2 else f" only {p} " for p in prompts])
        return said.select("doc_id", documents.commentary(F.col("answer"), F.col("prompt")).alias("said"))

    register(
        "commentary_answers",
        (
            "SELECT CAST(doc_id AS BIGINT) AS doc_id, CASE WHEN len('P' || doc_id) % 2 = 1 THEN 'says ' || len('P' || doc_id) ELSE 'only "
            "P' || doc_id END AS said FROM documents WHERE text IS NOT NULL"
        ),
    )(
        answers,
    )

    def classified(s: SparkSession, d: str) -> DataFrame:
        """News that a model finds meaningful: prompts in batches, answers parsed, the others left out."""
        rows = tables.table(s, d, "documents").select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            "source",
            documents.classify_prompt(F.coalesce("text", F.lit("")), 'Is this news item meaningful? "{text}" Answer 0 or 1:').alias("prompt"),
        )
        said = documents.run_model(rows, "prompt", "answer", lambda: lambda prompts: [f" {len(p) % 2}, by its length" for p in prompts], 256)
        return said.where(documents.parse_label(F.col("answer")) == 1).select("doc_id", "source")

    register(
        "classified_news",
        (
            "SELECT CAST(doc_id AS BIGINT) AS doc_id, source FROM documents WHERE length('Is this news item meaningful? \"' || "
            "replace(trim(coalesce(text, ''), ' '), '\"', '\\\"') || '\" Answer 0 or 1:') % 2 = 1"
        ),
    )(classified)

    def scanned(s: SparkSession, d: str) -> DataFrame:
        """Features of two cadences as CSV files, found and typed by a configuration file."""
        root = folder(s, "features")
        merged = catalog.merged(s, d)
        for cadence in ("week", "month"):
            made = spectral.wide(spectral.fft_windows(merged, names[:2], cadence, "hour", 32, 16), names[:2], [*suffixes[:2], "centroid_freq_cpb"])
            tables.write_csv_by_name(made.withColumnRenamed("win_end", "timestamp"), f"{root}/fft_{cadence}", order="timestamp")
        config = {"template": f"{root}/fft_{{cad}}", "cadences": ["week", "month"], "series": names[:2], "suffixes": suffixes[:2]}
        s.createDataFrame([(json.dumps(config),)], "value string").coalesce(1).write.text(f"{root}/config")
        return rounded(scans.scan_all(s, scans.load(s, f"{root}/config")))

    two = " UNION ALL ".join(
        f"SELECT ticker, '{c}' AS cadence, win_end AS ts, {', '.join(columns)} FROM ("
        + spectra.wide(spectra.fft_windows("merged", names[:2], c, 6, 32, 16), names[:2], suffixes[:2])
        + ")"
        for c in ("week", "month")
    )
    register("config_scan", sql.query(["merged"], two, columns))(scanned)
    offset = "ts - timezone('UTC', timezone('America/New_York', ts))"
    at = "TIMESTAMP '2024-03-01' + to_minutes(CAST(doc_id * 97 AS BIGINT))"
    register("summer_time", f"SELECT CAST(doc_id AS BIGINT) AS doc_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN {offset} = INTERVAL (-4) HOUR THEN '-04:00' ELSE '-05:00' END AS at FROM (SELECT doc_id, {at} AS ts FROM documents)")(
        lambda s, d: tables.table(s, d, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), documents.iso_with_offset(F.lit("2024-03-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("doc_id") * 97).cast("int"))).alias("at"))
    )
    register("tags", "SELECT CAST(page_id AS BIGINT) AS page_id, lower(trim(x, ' ')) AS tag FROM (SELECT page_id, unnest(string_split(' ' || replace(url, '/', ' , ') || ' ', ',')) AS x FROM pages) WHERE trim(x, ' ') <> ''")(
        lambda s, d: tables.table(s, d, "pages").select(F.col("page_id").cast("bigint").alias("page_id"), F.explode(documents.comma_list(F.concat(F.lit(" "), F.replace("url", F.lit("/"), F.lit(" , ")), F.lit(" ")))).alias("tag"))
    )
