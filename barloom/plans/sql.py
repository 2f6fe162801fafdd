"""DuckDB SQL of the queries, built from named subqueries."""

from __future__ import annotations

import re

TICKS = "SELECT event_type AS ticker, ts, event_id AS seq, value AS price, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS size FROM events"
TRADES = (
    "SELECT l_returnflag AS ticker, l_shipdate AS ts, (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS seq, "
    "l_extendedprice / l_quantity AS price, l_quantity AS size FROM lineitem"
)
PRINTS = (
    "SELECT l_returnflag AS ticker, TIMESTAMP '2024-03-04 09:30:00' + to_days(CAST(floor(sqrt(l_orderkey % 400)) AS INTEGER)) + to_minutes(CAST((l_partkey * 31 + l_suppkey * 7 + l_linenumber * 101) % 390 AS BIGINT)) AS ts, "
    "(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS seq, l_extendedprice / l_quantity AS price, l_quantity AS size FROM lineitem"
)
MINUTE = "(hour(ts) * 60 + minute(ts))"
PRICES = ("open", "high", "low", "close", "vwap", "volume", "transactions")


def start(unit: str) -> str:
    return f"date_trunc('{unit}', ts)::TIMESTAMP"


def bars(source: str, unit: str) -> str:
    return (
        f"SELECT ticker, {start(unit)} AS ts, first(price ORDER BY ts, seq) AS open, max(price) AS high, min(price) AS low, last(price ORDER BY ts, seq) AS close, "
        f"sum(size) AS volume, CASE WHEN sum(size) <> 0 THEN sum(price * size) / sum(size) END AS vwap, count(*)::BIGINT AS transactions FROM {source} GROUP BY 1, 2"
    )


def ema(x: str, name: str, source: str, alpha: str) -> str:
    """``source`` with ``name``: the fold of all non-null values so far."""
    return (
        f"SELECT * EXCLUDE (__l), CASE WHEN len(__l) > 0 THEN list_reduce(__l, lambda a, v: a * (1 - {alpha}) + v * {alpha}) END AS {name} FROM "
        f"(SELECT *, list({x}::DOUBLE) FILTER ({x} IS NOT NULL) OVER (PARTITION BY ticker ORDER BY ts ROWS UNBOUNDED PRECEDING) AS __l FROM {source})"
    )


K = "PARTITION BY ticker ORDER BY ts"
D = "PARTITION BY ticker, day_id ORDER BY ts"


def rolling(f: str, x: str, n: int, least: int, w: str = K) -> str:
    frame = f"OVER ({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) {frame} >= {least} THEN {f}({x}) {frame} END"


def ffill(x: str, k: int) -> str:
    return f"last_value({x} IGNORE NULLS) OVER ({D} ROWS BETWEEN {k} PRECEDING AND CURRENT ROW)"


def bfill(x: str, k: int) -> str:
    return f"first_value({x} IGNORE NULLS) OVER ({D} ROWS BETWEEN CURRENT ROW AND {k} FOLLOWING)"


def two_sided(x: str, k: int) -> str:
    f, b = ffill(x, k), bfill(x, k)
    return f"coalesce({x}, ({f} + {b}) / 2, {f}, {b})"


def window_end(ts: str, cadence: str) -> str:
    d = f"CAST({ts} AS DATE)"
    return {
        "hour": f"date_trunc('hour', {ts}) + INTERVAL 1 HOUR",
        "day": f"date_trunc('day', {ts} - INTERVAL 1 MICROSECOND) + INTERVAL 1 DAY",
        "week": f"({d} + CAST((12 - isodow({d})) % 7 AS INTEGER))::TIMESTAMP",
        "month": f"last_day({d})::TIMESTAMP",
        "quarter": f"(date_trunc('quarter', {d}) + INTERVAL 3 MONTH - INTERVAL 1 DAY)::TIMESTAMP",
        "year": f"make_date(year({d}), 12, 31)::TIMESTAMP",
    }[cadence]


def longest(source: str, keys: str, state: str, name: str) -> str:
    w = f"PARTITION BY {keys} ORDER BY ts"
    return (
        f"SELECT {keys}, max(n)::BIGINT AS {name} FROM (SELECT {keys}, run, count(s) AS n FROM (SELECT *, sum(new) OVER ({w} ROWS UNBOUNDED PRECEDING) AS run FROM "
        f"(SELECT *, CASE WHEN s IS NOT DISTINCT FROM lag(s) OVER ({w}) AND row_number() OVER ({w}) > 1 THEN 0 ELSE 1 END AS new FROM (SELECT *, {state} AS s FROM {source}))) GROUP BY {keys}, run) GROUP BY {keys}"
    )


STEPS: dict[str, tuple[list[str], str]] = {
    "ticks": ([], TICKS),
    "trades": ([], TRADES),
    "hour_bars": (["ticks"], bars("ticks", "hour")),
    "minute_bars": (["ticks"], bars("ticks", "minute")),
    "day_bars": (["trades"], bars("trades", "day")),
    "changes": (["hour_bars"], f"SELECT *, close - lag(close) OVER ({K}) AS d, close / nullif(lag(close) OVER ({K}), 0) - 1 AS ret FROM hour_bars"),
    "ranges": (["hour_bars"], f"SELECT *, greatest(high - low, abs(high - lag(close) OVER ({K})), abs(low - lag(close) OVER ({K}))) AS tr FROM hour_bars"),
    "atrs": (["ranges"], f"SELECT *, {rolling('avg', 'tr', 14, 1)} AS atr_14 FROM ranges"),
    "bands": (["atrs"], f"SELECT *, {rolling('avg', 'close', 20, 20)} AS bb_mid_20, {rolling('stddev_samp', 'close', 20, 20)} AS sd FROM atrs"),
    "banded": (["bands"], "SELECT * EXCLUDE (sd), bb_mid_20 + 2 * sd AS bb_up_20, bb_mid_20 - 2 * sd AS bb_dn_20, (bb_mid_20 + 2 * sd - (bb_mid_20 - 2 * sd)) / nullif(bb_mid_20, 0) AS bb_bw_20 FROM bands"),
    "fast": (["hour_bars"], ema("close", "e12", "hour_bars", "(2.0::DOUBLE / 13)")),
    "slow": (["fast"], ema("close", "e26", "fast", "(2.0::DOUBLE / 27)")),
    "macds": (["slow"], "SELECT *, e12 - e26 AS macd FROM slow"),
    "signals": (["macds"], ema("macd", "macd_signal", "macds", "(2.0::DOUBLE / 10)")),
    "moves": (["changes"], "SELECT *, CASE WHEN d IS NOT NULL THEN greatest(d, 0) END AS up, CASE WHEN d IS NOT NULL THEN greatest(-d, 0) END AS down FROM changes"),
    "gains": (["moves"], ema("up", "g", "moves", "(1.0::DOUBLE / 14)")),
    "losses": (["gains"], ema("down", "l", "gains", "(1.0::DOUBLE / 14)")),
    "rth": (["banded"], f"SELECT * FROM banded WHERE {MINUTE} BETWEEN 570 AND 959"),
    "days": (["rth"], "SELECT DISTINCT ticker, CAST(ts AS DATE) AS day_id FROM rth"),
    "grid": (["days"], "SELECT ticker, day_id, day_id::TIMESTAMP + to_hours(CAST(h AS INTEGER)) AS ts FROM days, range(10, 16) AS t(h)"),
    "aligned": (["grid", "rth"], f"SELECT g.ticker, g.ts, g.day_id, {', '.join(PRICES)}, atr_14, bb_bw_20, CASE WHEN {' OR '.join(f'{c} IS NULL' for c in PRICES)} THEN 1 ELSE 0 END AS is_gap FROM grid g LEFT JOIN rth r ON g.ticker = r.ticker AND g.ts = r.ts"),
    "filled": (["aligned"], "SELECT ticker, ts, day_id, is_gap, " + ", ".join(f"{two_sided(f'{c}::DOUBLE', 3)} AS {c}" for c in (*PRICES, "atr_14", "bb_bw_20")) + " FROM aligned"),
    "forward": (["filled"], f"SELECT *, {ffill('close', 1)} AS f1, {ffill('close', 2)} AS f2, row_number() OVER ({D}) AS rn FROM filled"),
    "backfilled": (["forward"], f"SELECT *, {bfill('f1', 1)} AS c1, {bfill('f2', 2)} AS c2 FROM forward"),
    "returned": (["backfilled"], "SELECT *, " + ", ".join(f"CASE WHEN rn = 1 THEN 0 ELSE CASE WHEN c{k} > 0 THEN ln(c{k}) END - lag(CASE WHEN c{k} > 0 THEN ln(c{k}) END) OVER ({D}) END AS r{k}" for k in (1, 2)) + " FROM backfilled"),
    "valid": (["returned"], "SELECT *, " + ", ".join(f"count(r{k}) OVER (PARTITION BY ticker, day_id)::DOUBLE / count(*) OVER (PARTITION BY ticker, day_id) AS v{k}" for k in (1, 2)) + " FROM returned"),
    "chosen": (["valid"], "SELECT *, CASE WHEN v1 < 0.7 AND v2 > v1 THEN r2 ELSE r1 END AS r_close, CASE WHEN v1 < 0.7 AND v2 > v1 THEN 2 ELSE 1 END AS rclose_limit_used FROM valid"),
    "merged": (
        ["chosen"],
        f"SELECT *, close - vwap AS spread_vwap, avg(atr_14) OVER (PARTITION BY ticker, day_id) AS ATR_14_day_mean, (close - vwap) / nullif(avg(atr_14) OVER (PARTITION BY ticker, day_id), 0) AS spread_vwap_norm, "
        f"CAST(rn - 1 AS INTEGER) AS bar_index_since_open, CAST({MINUTE} - 570 AS INTEGER) AS minutes_since_open, "
        "coalesce((volume - avg(volume) OVER (PARTITION BY ticker, rn)) / nullif(stddev_samp(volume) OVER (PARTITION BY ticker, rn), 0), 0) AS volume_z_by_tod FROM chosen",
    ),
    "cumulated": (["merged"], f"SELECT *, sum(coalesce(r_close, 0)) OVER ({D} ROWS UNBOUNDED PRECEDING) AS cum, CASE WHEN r_close IS NOT NULL THEN minutes_since_open::DOUBLE END AS vt FROM merged"),
    "day_rows": ([], "SELECT ticker, CAST(ts AS DATE) AS day_id, ln(close / open) AS ret_oc, ln(close / open) * ln(close / open) AS rv, (high - low) / nullif(vwap, 0) AS range_share, CASE WHEN transactions % 5 <> 0 THEN volume END AS volume, transactions AS valid_bars FROM day_bars"),
    "news": ([], "SELECT source AS ticker, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc_id AS BIGINT)) AS ts, CAST(doc_id AS BIGINT) AS doc_id, text FROM documents"),
    "items": (["news"], "SELECT ticker || '/' || strftime(ts, '%Y-%m-%d') AS file, row_number() OVER (PARTITION BY ticker, CAST(ts AS DATE) ORDER BY ts, news.doc_id) - 1 AS idx, quality AS label, news.doc_id AS doc_id FROM news JOIN labels ON news.doc_id = labels.doc_id"),
}
STEPS["day_rows"] = (["day_bars"], STEPS["day_rows"][1])


#: The steps from bars to daily features, which can start from other bars too.
FROM_BARS = (
    "changes",
    "ranges",
    "atrs",
    "bands",
    "banded",
    "rth",
    "days",
    "grid",
    "aligned",
    "filled",
    "forward",
    "backfilled",
    "returned",
    "valid",
    "chosen",
    "merged",
    "cumulated",
)


def derive(prefix: str, bars: str, grid: str, day: str = "day_id") -> None:
    """The steps FROM_BARS over ``bars``, named with ``prefix``, on ``grid`` in place of the hour grid."""
    renamed = {n: prefix + n for n in FROM_BARS} | {"hour_bars": bars}
    swap = lambda text: re.sub(r"\b(FROM|JOIN) (\w+)", lambda m: f"{m[1]} {renamed.get(m[2], m[2])}", text)
    for n in FROM_BARS:
        uses, text = STEPS[n]
        STEPS[prefix + n] = ([renamed.get(u, u) for u in uses], swap(grid if n == "grid" else text))


STEPS["prints"] = ([], PRINTS)
STEPS["print_bars"] = (["prints"], bars("prints", "minute"))
STEPS["half_ticks"] = (["prints"], "SELECT ticker, ts - CASE WHEN ticker = 'A' THEN INTERVAL 30 MINUTE ELSE INTERVAL 0 MINUTE END AS ts, seq, price, size FROM prints")
STEPS["half_bars"] = (
    ["half_ticks"],
    f"SELECT * REPLACE (ts + CASE WHEN ticker = 'A' THEN INTERVAL 30 MINUTE ELSE INTERVAL 0 MINUTE END AS ts) FROM ({bars('half_ticks', 'hour')})",
)
derive("m_", "print_bars", "SELECT ticker, day_id, day_id::TIMESTAMP + to_minutes(CAST(570 + m AS BIGINT)) AS ts FROM days, range(0, 390) AS t(m)")
derive(
    "h_",
    "half_bars",
    (
        "SELECT ticker, day_id, day_id::TIMESTAMP + to_minutes(CAST(CASE WHEN ticker = 'A' THEN 570 ELSE 600 END + 60 * h AS BIGINT)) "
        "AS ts FROM days, range(0, 6) AS t(h)"
    ),
)


def needs(names: list[str], seen: dict[str, None] | None = None) -> dict[str, None]:
    seen = {} if seen is None else seen
    for n in names:
        needs(STEPS[n][0], seen)
        seen[n] = None
    return seen


def query(uses: list[str], body: str, round_: list[str] | None = None) -> str:
    """``body`` over its subqueries; the columns ``round_`` at six places."""
    ctes = ", ".join(f"{n} AS ({STEPS[n][1]})" for n in needs(uses))
    if round_:
        body = f"SELECT * REPLACE ({', '.join(f'round({c}::DOUBLE, 6) + 0.0 AS {c}' for c in round_)}) FROM ({body})"
    return f"WITH {ctes} {body}" if ctes else body
