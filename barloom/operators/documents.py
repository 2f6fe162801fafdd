"""Nested day documents: features and news joined, deduplicated, filtered, labelled and turned into prompts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.functions.series import number

# fixed values: features that the published documents leave out
DROPPED = [
    "agg.reversal_score", "cwt.r_close_CWT_power_hi", "fft.bb_bw_20_pct_mid", "fft.r_close_pct_hi", "fft.spread_vwap_norm_pct_hi", "fft.volume_z_by_tod_pct_mid",
    "inter.close", "inter.ema_12", "inter.ema_26", "inter.low", "inter.macd", "inter.macd_hist", "inter.macd_signal", "inter.open", "inter.r_close", "inter.sma_20", "inter.sma_50", "inter.stoch_d_14", "inter.stoch_k_14",
]
SHIFTS = {"treat_as_start": 1, "as_is": 0, "minus_1h": -1}
#: Hours and tag by the mode that a caller names; any other name leaves times as they are.
ALIGN = {"treat_as_start": (1, "treat_as_start"), "treat_as_end": (0, "treat_as_end"), "as_is": (0, "treat_as_end")}


def long_features(df: DataFrame, prefix: str, columns: list[str], source: int, at: str = "end_ts") -> DataFrame:
    """(ticker, end_ts, key, value, source, seq): one row for each of ``columns`` that ``df`` has; no number: null."""
    pairs = F.array(*[F.struct(F.lit(f"{prefix}.{c}").alias("key"), number(F.col(f"`{c}`")).alias("value")) for c in columns if c in df.columns])
    seq = F.col("seq").cast("bigint") if "seq" in df.columns else F.lit(0).cast("bigint")
    rows = df.where(F.col(at).isNotNull()).select(
        "ticker",
        F.col(at).alias("end_ts"),
        F.lit(source).alias("source"),
        seq.alias("seq"),
        F.explode(pairs).alias("p"),
    )
    return rows.select("ticker", "end_ts", F.col("p.key").alias("key"), F.col("p.value").alias("value"), "source", "seq")


def series_features(df: DataFrame, prefix: str, names: list[str], suffixes: list[str], source: int, at: str = "end_ts") -> DataFrame:
    """long_features of every {series}_{suffix} column that ``df`` has."""
    return long_features(df, prefix, [f"{n}_{s}" for n in names for s in suffixes], source, at)


def latest(features: DataFrame) -> DataFrame:
    """One value for each key of an hour: of a source's rows the last, of clashing sources the later that has a value.

    The last row counts as it is: where it has no value, an earlier row of the source does not stand in for it.
    One shuffle on the day serves both aggregates and the document's.
    """
    day = features.withColumn("date", F.to_date("end_ts")).repartition("ticker", "date")
    last = day.groupBy("ticker", "date", "end_ts", "key", "source").agg(F.max_by("value", "seq").alias("value")).where("value is not null")
    return last.groupBy("ticker", "date", "end_ts", "key").agg(F.max_by("value", "source").alias("value"))


def per_hour(features: DataFrame) -> DataFrame:
    """(ticker, date, per_hour_data): HH:mm -> key -> value, of days with a feature."""
    hours = latest(features).groupBy("ticker", "date", F.date_format("end_ts", "HH:mm").alias("hour")).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("m"),
    )
    return hours.groupBy("ticker", "date").agg(F.map_from_entries(F.collect_list(F.struct("hour", "m"))).alias("per_hour_data"))


def iso_with_offset(ts: Column, zone: str = "America/New_York") -> Column:
    """yyyy-MM-ddTHH:mm:ss with the zone's offset at that wall-clock time; where an hour comes twice, that of the second."""
    to_utc = lambda t: F.convert_timezone(F.lit(zone), F.lit("UTC"), t)
    tomorrow = ts + F.expr("interval 1 day")
    # a time that the next day's offset gives too comes twice, or has that offset anyway
    second = ts + (to_utc(tomorrow) - tomorrow)
    comes = F.convert_timezone(F.lit("UTC"), F.lit(zone), second) == ts
    offset = F.timestamp_diff("MINUTE", F.when(comes, second).otherwise(to_utc(ts)), ts)
    hours = F.format_string("%s%02d:%02d", F.when(offset < 0, "-").otherwise("+"), F.floor(F.abs(offset) / 60).cast("int"), (F.abs(offset) % 60).cast("int"))
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), hours)


def news_text(*parts: Column) -> Column:
    """The parts that say something, joined with spaces."""
    return F.trim(F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts]))


def news_per_day(news: DataFrame, zone: str = "America/New_York") -> DataFrame:
    """(ticker, date, news): items in time order, with the offsets of ``zone``. A day's items of one ticker are one row by definition."""
    item = F.struct(F.col("ts"), F.col("url"), F.col("text"))
    days = news.where("ts is not null").groupBy("ticker", F.to_date("ts").alias("date")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    return days.select(
        "ticker",
        "date",
        F.transform("items", lambda x: F.struct(iso_with_offset(x["ts"], zone).alias("timestamp_et"), x["text"].alias("text"), x["url"].alias("url"))).alias(
            "news",
        ),
    )


def assemble(features: DataFrame, news: DataFrame) -> DataFrame:
    """Documents of the days that have both a featured hour and news."""
    return per_hour(features).join(news_per_day(news), ["ticker", "date"]).select(
        "ticker",
        F.col("date").cast("string").alias("date"),
        "news",
        "per_hour_data",
    )


def auto_shift(inter: DataFrame, marks: DataFrame) -> DataFrame:
    """``inter`` with end_ts: its ts moved by the hour that meets most of the ticker's marks; ties +1, 0, -1."""
    pairs = F.array(*[F.struct(F.lit(k).alias("tag"), F.lit(v).alias("h"), F.lit(1 - v).alias("pref")) for k, v in SHIFTS.items()])
    moved = inter.select("ticker", "ts", F.explode(pairs).alias("s")).withColumn("end_ts", F.col("ts") + F.make_dt_interval(hours=F.col("s.h")))
    hits = moved.join(marks.select("ticker", "end_ts").distinct().withColumn("hit", F.lit(1)), ["ticker", "end_ts"], "left")
    score = hits.groupBy("ticker", "s").agg(F.count("hit").alias("n"))
    best = score.groupBy("ticker").agg(F.min_by("s", F.struct(-F.col("n"), F.col("s.pref"))).alias("s"), F.max("n").alias("overlap"))
    return inter.join(best, "ticker").withColumn("end_ts", F.col("ts") + F.make_dt_interval(hours=F.col("s.h"))).withColumn("align", F.col("s.tag")).drop(
        "s",
    )


def align_hours(inter: DataFrame, mode: str, marks: DataFrame | None = None) -> DataFrame:
    """``inter`` with end_ts by a named mode, or by ``auto`` against ``marks``."""
    if mode == "auto" and marks is not None:
        return auto_shift(inter, marks)
    hours, tag = ALIGN.get(mode, (0, "as_is"))
    return inter.withColumn("end_ts", F.col("ts") + F.make_dt_interval(hours=F.lit(hours))).withColumn("align", F.lit(tag))


def has_features(hours: Column) -> Column:
    return F.exists(F.map_values(hours), lambda m: F.cardinality(m) > 0)


def drop_features(df: DataFrame, dropped: list[str] | None = None, column: str = "per_hour_data") -> DataFrame:
    gone = F.array(*map(F.lit, DROPPED if dropped is None else dropped))
    return df.withColumn(column, F.transform_values(column, lambda _, m: F.map_filter(m, lambda k, v: ~F.array_contains(gone, k))))


def drop_empty(df: DataFrame, column: str = "per_hour_data") -> DataFrame:
    """Null features, hours without features and documents without hours go."""
    live = F.map_filter(F.transform_values(column, lambda _, m: F.map_filter(m, lambda k, v: v.isNotNull())), lambda _, m: F.cardinality(m) > 0)
    return df.withColumn(column, live).where(has_features(F.col(column)))


def best_of(df: DataFrame, keys: list[str], featured: Column, size: Column, mtime: Column, seq: Column) -> DataFrame:
    """One row of each key: with features, then larger, then newer, then first."""
    w = W.partitionBy(*keys).orderBy(featured.desc(), size.desc(), mtime.desc(), seq)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def document_date(file: Column, inner: Column) -> Column:
    """The date that the file's name starts with, else the date inside where it is one."""
    name = F.nullif(F.regexp_extract(F.element_at(F.split(file, "/"), -1), r"^(\d{4}-\d{2}-\d{2})_", 1), F.lit(""))
    return F.coalesce(name, F.when(inner.rlike(r"^\d{4}-\d{2}-\d{2}$"), inner))


def comma_list(text: Column) -> Column:
    """The parts between commas, trimmed and in lower case, without empty ones."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.lower(F.trim(x))), lambda x: x != "")


def parse_label(output: Column) -> Column:
    return F.when(F.substring(F.trim(output), 1, 1) == "1", 1).otherwise(0)


def label_report(items: DataFrame) -> DataFrame:
    """Of (file, idx, label): files with a label 0, the places of those labels and the number of items."""
    zero = F.sort_array(F.collect_list(F.when(F.col("label") == 0, F.col("idx"))))
    return items.groupBy("file").agg(zero.alias("non_meaningful"), F.count(F.lit(1)).alias("num_news")).where(F.size("non_meaningful") > 0)


def keep_labelled(df: DataFrame, labels: DataFrame, key: str = "file") -> DataFrame:
    """News items whose label at the same place is 1; documents without any go."""
    of = labels.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("idx", "label"))).alias("__l"))
    kept = F.filter("news", lambda x, i: F.element_at("__l", i) == 1)
    return df.join(of, key).withColumn("news", kept).drop("__l").where(F.size("news") > 0)


def classify_prompt(text: Column, template: str) -> Column:
    head, _, tail = template.partition("{text}")
    return F.concat(F.lit(head), F.replace(F.trim(text), F.lit('"'), F.lit('\\"')), F.lit(tail))


def indented(hours: Column) -> Column:
    """An hour map as JSON, keys sorted on both levels, two spaces a level."""
    quoted = lambda k: F.concat(F.lit('"'), k, F.lit('": '))
    block = lambda cells, pad: F.when(F.size(cells) == 0, "{}").otherwise(F.concat(F.lit("{\n"), F.array_join(cells, ",\n"), F.lit(f"\n{pad}}}")))
    inner = lambda m: F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(F.lit("    "), quoted(e["key"]), F.coalesce(e["value"].cast("string"), F.lit("null"))))
    outer = F.transform(F.array_sort(F.map_keys(hours)), lambda k: F.concat(F.lit("  "), quoted(k), block(inner(F.element_at(hours, k)), "  ")))
    return block(outer, "")


def commentary(answer: Column, prompt: Column) -> Column:
    """What a model said, without the prompt that it may repeat first."""
    return F.trim(F.when(answer.startswith(prompt), F.substring(answer, F.length(prompt) + 1, F.length(answer))).otherwise(answer))


def commentary_prompt(ticker: Column, date: Column, hours: Column) -> Column:
    """The commentary prompt over an hour map, as indented JSON with sorted keys."""
    data = indented(hours)
    # fixed values: the prompt's wording
    return F.concat(
        F.lit("You are a financial market analyst.\nWrite a concise market commentary for "), ticker, F.lit(" on "), date,
        F.lit(" based on the intraday technical indicators below.\n\n<INTRADAY_DATA>\n"), data, F.lit("\n</INTRADAY_DATA>\n\nCommentary:\n"),
    )


Model = Callable[[list[str]], list[str]]
_MODELS: dict[str, Model] = {}


def _model(key: str, make: Callable[[], Model]) -> Model:
    """The model of ``key``, made once in each worker; that of another key goes."""
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = make()
    return _MODELS[key]


def _asked(model: Model, prompts: list[str]) -> pd.Series:
    said = model(prompts)
    if len(said) != len(prompts):
        raise ValueError("a model must answer every prompt")
    return pd.Series(said, dtype=object)


def run_model(df: DataFrame, prompt: str, out: str, make: Callable[[], Model], batch: int = 1000) -> DataFrame:
    """``df`` with ``out``: what the model that ``make`` makes answers to batches of prompts.

    The model is made on the executors, once in each Python worker. Batches are full ones whatever the Arrow batches
    are; only a task's last one may be smaller.
    """
    key = uuid.uuid4().hex

    @F.pandas_udf("string")
    def answer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _model(key, make)
        waiting: list[str] = []
        for prompts in batches:
            waiting += prompts.tolist()
            while len(waiting) >= batch:
                yield _asked(model, waiting[:batch])
                waiting = waiting[batch:]
        if waiting:
            yield _asked(model, waiting)

    return df.withColumn(out, answer(F.col(prompt)))


def universe(*tables: DataFrame) -> DataFrame:
    out = tables[0].select("ticker")
    for t in tables[1:]:
        out = out.union(t.select("ticker"))
    return out.distinct()


def common(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("ticker").intersect(b.select("ticker"))
