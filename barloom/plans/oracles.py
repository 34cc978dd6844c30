"""The same queries as SQL for an independent engine.

Definitions here are the plain, whole-series forms: one window per symbol, recursion for
exponential means, self joins for rank correlation. They share no logic with the operators.
"""

from __future__ import annotations

import re

from barloom import schema as S
from barloom.plans.catalog import (
    ACCOUNT,
    AMOUNT,
    BROKEN,
    CASCADE,
    CUT,
    EMPTY,
    ENTRY_LENGTH,
    ENTRY_POINT,
    EVENT_TYPES,
    EXACT,
    FINE,
    GRID_SEARCHES,
    INTERVAL,
    LEVEL,
    LINE_LEVEL,
    LOGS,
    LONG_INTERVAL,
    MODEL_EDGES,
    MODEL_LENGTH,
    MODEL_PARAMS,
    MODEL_POINT,
    MODEL_ROUNDS,
    NOW,
    OTHER,
    PRICE_SCALED,
    PROPOSED,
    SEARCH,
    SEARCH_ROUNDS,
    SEARCH_TRIALS,
    TIME,
    TOLD,
    TRIALS,
    UNROUNDED,
)
from barloom.operators import boost, sampler
from barloom.operators.model import PARAMETER_TYPES, classifier
from barloom.operators.search import SIGNAL_SPACE
from barloom.operators.search import signal_trials as random_trials

ORACLES: dict[str, str] = {}


def r(expr: str, name: str, digits: int = 6) -> str:
    """Rounded, without negative zero."""
    tiny = 0.5 * 10.0**-digits
    return f"CASE WHEN abs({expr}) < {tiny!r}::DOUBLE THEN 0.0::DOUBLE ELSE round({expr}, {digits}) END AS \"{name}\""


def rs(*names: str) -> str:
    return ", ".join(r(f'"{n}"', n) for n in names)


def d(x: float) -> str:
    return f"{float(x)!r}::DOUBLE"


def event_bars(interval: str = "15 minutes", level: float = 0.0, whole: bool = False) -> str:
    price = f"value + {d(level)}" if level else "value"
    symbol = "'all'" if whole else "event_type"
    return f"""bars AS (
  SELECT {symbol} AS symbol, time_bucket(INTERVAL '{interval}', ts) AS bar_ts,
    first({price} ORDER BY ts, event_id) AS open, max({price}) AS high, min({price}) AS low,
    last({price} ORDER BY ts, event_id) AS close, sum(1.0::DOUBLE) AS volume
  FROM events GROUP BY 1, 2)"""


RAW = ", ".join(S.OHLCV)


def line_bars(level: float = 0.0) -> str:
    price = "l_extendedprice / l_quantity" + (f" + {d(level)}" if level else "")
    order = "ORDER BY l_orderkey, l_partkey, l_linenumber"
    return f"""bars AS (
  SELECT l_suppkey::VARCHAR AS symbol, time_bucket(INTERVAL '1 day', l_shipdate) AS bar_ts,
    first({price} {order}) AS open, max({price}) AS high, min({price}) AS low,
    last({price} {order}) AS close, sum(l_quantity) AS volume
  FROM lineitem GROUP BY 1, 2)"""


LINE_BARS = line_bars()

POS = """pos AS (
  SELECT symbol, bar_ts AS ts, open, high, low, close, volume,
    row_number() OVER (PARTITION BY symbol ORDER BY bar_ts) - 1 AS i,
    count(*) OVER (PARTITION BY symbol) AS n
  FROM bars)"""


def w(n: int | None = None) -> str:
    frame = "" if n is None else f" ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"
    return f"OVER (PARTITION BY symbol ORDER BY i{frame})"


def full(n: int, expr: str) -> str:
    return f"CASE WHEN i >= {n - 1} THEN {expr} END"


def ln(x: str) -> str:
    return f"CASE WHEN ({x}) > 0 THEN ln({x}) END"


# -- bars -----------------------------------------------------------------------------------------

for _name, _interval in (("resample_5m", "5 minutes"), ("resample_15m", "15 minutes"), ("resample_1h", "1 hour")):
    ORACLES[_name] = f"WITH {event_bars(_interval)} SELECT symbol, bar_ts AS ts, {RAW} FROM bars"
ORACLES["resample_1m"] = f"WITH {event_bars('1 minute')} SELECT symbol, bar_ts AS ts, {RAW} FROM bars"
ORACLES["resample_cascade"] = " UNION ALL ".join(
    f"(WITH {event_bars(i)} SELECT symbol, bar_ts AS ts, {rs(*S.OHLCV)}, '{i}' AS \"interval\" FROM bars)" for i in CASCADE
)
ORACLES["stream_resample_complete"] = ORACLES["resample_1h"]
ORACLES["resample_lines_1d"] = f"WITH {LINE_BARS} SELECT symbol, bar_ts AS ts, {RAW} FROM bars"
ORACLES["row_positions"] = f"WITH {LINE_BARS}, {POS} SELECT symbol, ts, i, n FROM pos"
ORACLES["stream_resample_15m"] = f"""WITH {event_bars()}
SELECT symbol, bar_ts AS ts, {RAW} FROM bars
WHERE bar_ts + INTERVAL '15 minutes' <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL '10 minutes'"""
ORACLES["stream_cascade_15m"] = f"SELECT symbol, ts, {rs(*S.OHLCV)} FROM ({ORACLES['stream_resample_15m']})"
ORACLES["stream_log"] = """SELECT 'pulls' AS name, event_id % 3 AS batch, count(*) AS rows, true AS timed FROM events GROUP BY 2"""
ORACLES["stream_upsert_bars"] = f"""SELECT event_type AS symbol, date_trunc('minute', ts) AS ts,
  max(event_id) AS version, {r('last(value ORDER BY event_id)', 'price')} FROM events GROUP BY 1, 2"""

# -- running --------------------------------------------------------------------------------------

ORACLES["running_sum"] = f"""WITH {LINE_BARS}, {POS}
SELECT symbol, ts, {rs('volume')}, {r(f'sum(volume) {w()}', 'total')} FROM pos"""

_HELD = f"""{event_bars(level=100.0)}, {POS},
moves AS (SELECT *, CASE WHEN close / open > 1.01::DOUBLE THEN 1 WHEN close / open < 0.99::DOUBLE THEN -1 END AS move FROM pos),
held AS (SELECT *, coalesce(last_value(move IGNORE NULLS) {w()}, 0) AS held FROM moves)"""
ORACLES["fill_forward"] = f"WITH {_HELD} SELECT symbol, ts, move, held FROM held"
ORACLES["sum_between_flips"] = f"""WITH {_HELD},
flips AS (SELECT *, held * lag(held) {w()} < 0 AS flip FROM held),
grp AS (SELECT *, sum(coalesce(flip, false)::BIGINT) {w()} AS stretch FROM flips)
SELECT symbol, ts, held, stretch::BIGINT AS stretch,
  {r('sum(volume) OVER (PARTITION BY symbol, stretch ORDER BY i)', 'stretch_volume')} FROM grp"""
ORACLES["rolling_python"] = f"""WITH {event_bars()}, {POS}
SELECT symbol, ts, {r(full(9, f'(max(close) {w(9)} - min(close) {w(9)})'), 'spread')} FROM pos"""

# -- features -------------------------------------------------------------------------------------


def levels_sql(levels: dict[str, str], source: str) -> str:
    """Log differences of named level expressions, as a CTE pair ``lv`` and ``ld``."""
    made = ", ".join(f'{expr} AS "{n}"' for n, expr in levels.items())
    logs = ", ".join(f'{ln(f"""{chr(34)}{n}{chr(34)}""")} - {ln(f"""lag({chr(34)}{n}{chr(34)}) {w()}""")} AS "{n}"' for n in levels)
    return f"lv AS (SELECT symbol, ts, i, {made} FROM {source}), ld AS (SELECT symbol, ts, i, {logs} FROM lv)"


def sma_levels() -> dict[str, str]:
    return {f"SMA{n}": full(n, f"avg(close) {w(n)}") for n in S.SMA_LENGTHS}


def bb_levels() -> dict[str, str]:
    mean, std = f"avg(close) {w(20)}", f"stddev_pop(close) {w(20)}"
    levels = {}
    for k in S.BB_WIDTHS:
        levels[f"BBL_20_{k}.0"] = full(20, f"{mean} - {k} * {std}")
        levels[f"BBM_20_{k}.0"] = full(20, mean)
        levels[f"BBU_20_{k}.0"] = full(20, f"{mean} + {k} * {std}")
    return levels


def reg_levels() -> dict[str, str]:
    return {
        f"REG{n}": full(n, f"regr_intercept(close, i) {w(n)} + regr_slope(close, i) {w(n)} * i")
        for n in S.REG_LENGTHS
    }


def plain_exprs(group: str) -> dict[str, str]:
    if group == "time":
        return {
            "day_sin": "sin(day(ts))", "day_cos": "cos(day(ts))",
            "hour_sin": "sin(hour(ts))", "hour_cos": "cos(hour(ts))",
        }
    if group == "log_diff":
        return {f"{c}_log_diff": f"{ln(c)} - {ln(f'lag({c}) {w()}')}" for c in S.OHLCV}
    if group == "mom":
        return {f"MOM{n}": f"close - lag(close, {n}) {w()}" for n in S.MOM_LENGTHS}
    if group == "roc":
        return {
            f"ROC{n}": f"100.0::DOUBLE * (close - lag(close, {n}) {w()}) / nullif(lag(close, {n}) {w()}, 0)"
            for n in S.ROC_LENGTHS
        }
    if group == "bb_width":
        return {f"BB_20_{k}.0": full(20, f"{2 * k} * stddev_pop(close) {w(20)}") for k in S.BB_WIDTHS}
    constant = "max(close) {0} = min(close) {0}"
    if group == "skew":
        return {
            f"SKEW{n}": full(n, f"CASE WHEN {constant.format(w(n))} THEN 0.0::DOUBLE ELSE skewness(close) {w(n)} END")
            for n in S.MOMENT_LENGTHS
        }
    return {
        f"KURT{n}": full(n, f"CASE WHEN {constant.format(w(n))} THEN -3.0::DOUBLE ELSE kurtosis(close) {w(n)} END")
        for n in S.MOMENT_LENGTHS
    }


_PLAIN = ("time", "log_diff", "mom", "roc", "bb_width", "skew", "kurt")
_LEVELS = {"sma": sma_levels, "bb": bb_levels, "reg": reg_levels}


def recursive_features(base: str) -> str:
    """All exponential features by row-by-row recursion; CTE ``ew`` (WITH RECURSIVE needed)."""
    start, step, pick = [], [], {}
    for c in S.EMA_COMS:
        decay = d(1 - 1 / (1 + c))
        start += [f"close AS en{c}", f"1.0::DOUBLE AS ed{c}"]
        step += [f"p.close + {decay} * q.en{c}", f"1.0 + {decay} * q.ed{c}"]
        pick[f"EMA{c}"] = f"en{c} / ed{c}"
    for n in S.ATR_LENGTHS:
        decay = d(1 - 1 / n)
        start += [f"tr AS an{n}", f"1.0::DOUBLE AS ad{n}"]
        step += [f"p.tr + {decay} * q.an{n}", f"1.0 + {decay} * q.ad{n}"]
        pick[f"ATR{n}"] = full(n, f"an{n} / ad{n}")
    for n in S.RSI_LENGTHS:
        decay = d(1 - 1 / n)
        start += [f"0.0::DOUBLE AS ru{n}", f"0.0::DOUBLE AS rd{n}"]
        step += [f"greatest(p.chg, 0) + {decay} * q.ru{n}", f"greatest(-p.chg, 0) + {decay} * q.rd{n}"]
        pick[f"RSI{n}"] = f"CASE WHEN i >= {n} THEN 100.0::DOUBLE * ru{n} / nullif(ru{n} + rd{n}, 0) END"

    def seeded(name: str, value: str, seed: str, n: int, first: int) -> None:
        alpha = 2 / (n + 1)
        start.append(f"NULL::DOUBLE AS {name}")
        step.append(
            f"CASE WHEN p.i < {first} THEN NULL WHEN p.i = {first} THEN {seed}"
            f" ELSE {d(1 - alpha)} * q.{name} + {d(alpha)} * {value} END"
        )

    seeded("f12", "p.close", "p.seed12", 12, 11)
    seeded("s26", "p.close", "p.seed26", 26, 25)
    names = ", ".join(f'{expr} AS "{n}"' for n, expr in pick.items())
    return f"""prep AS (SELECT *, close - lag(close) {w()} AS chg,
    greatest(high - low, abs(high - lag(close) {w()}), abs(lag(close) {w()} - low)) AS tr,
    avg(close) {w(12)} AS seed12, avg(close) {w(26)} AS seed26 FROM {base}),
ew0 AS (
  SELECT symbol, ts, i, {', '.join(start)} FROM prep WHERE i = 0
  UNION ALL
  SELECT p.symbol, p.ts, p.i, {', '.join(step)} FROM ew0 q JOIN prep p ON p.symbol = q.symbol AND p.i = q.i + 1),
ew AS (SELECT symbol, ts, i, {names}, f12 - s26 AS macd FROM ew0),
mprep AS (SELECT symbol, ts, i, macd, avg(macd) {w(9)} AS seed9 FROM ew),
sg AS (
  SELECT symbol, i, NULL::DOUBLE AS sig FROM mprep WHERE i = 0
  UNION ALL
  SELECT p.symbol, p.i, CASE WHEN p.i < 33 THEN NULL WHEN p.i = 33 THEN p.seed9
    ELSE {d(0.8)} * q.sig + {d(0.2)} * p.macd END
  FROM sg q JOIN mprep p ON p.symbol = q.symbol AND p.i = q.i + 1),
exps AS (SELECT ew.*, macd AS "MACD_12_26_9", macd - sig AS "MACD_h12_26_9", sig AS "MACDs_12_26_9"
  FROM ew JOIN sg USING (symbol, i)),
emad AS (SELECT symbol, i, {', '.join(f'{ln(f"EMA{c}")} - {ln(f"lag(EMA{c}) {w()}")} AS "EMA{c}"' for c in S.EMA_COMS)} FROM ew)"""


def rci_sql(base: str) -> str:
    """Rank correlations by ranking every window explicitly; CTE ``rci``."""
    ctes = []
    for n in S.RCI_LENGTHS:
        ctes.append(f"""rk{n} AS (SELECT a.symbol, a.i, b.i - a.i + {n} AS y,
    rank() OVER (PARTITION BY a.symbol, a.i ORDER BY b.close)
      + (count(*) OVER (PARTITION BY a.symbol, a.i, b.close) - 1) / 2.0::DOUBLE AS rk
  FROM {base} a JOIN {base} b ON b.symbol = a.symbol AND b.i BETWEEN a.i - {n - 1} AND a.i WHERE a.i >= {n - 1}),
rc{n} AS (SELECT symbol, i, 1 - 6 * sum((rk - y) * (rk - y)) / ({n} * ({n} * {n} - 1))::DOUBLE AS "RCI{n}" FROM rk{n} GROUP BY 1, 2)""")
    joins = " ".join(f"LEFT JOIN rc{n} USING (symbol, i)" for n in S.RCI_LENGTHS)
    names = ", ".join(f'"RCI{n}"' for n in S.RCI_LENGTHS)
    return ",\n".join(ctes) + f",\nrci AS (SELECT symbol, ts, i, {names} FROM {base} {joins})"


def cci_sql(base: str) -> str:
    ctes = [f"tp AS (SELECT symbol, ts, i, (high + low + close) / 3.0::DOUBLE AS tp FROM {base})"]
    for n in S.CCI_LENGTHS:
        ctes.append(f"""cm{n} AS (SELECT *, avg(tp) {w(n)} AS m FROM tp),
cd{n} AS (SELECT a.symbol, a.i, a.tp - a.m AS dev, avg(abs(b.tp - a.m)) AS mad FROM cm{n} a
  JOIN tp b ON b.symbol = a.symbol AND b.i BETWEEN a.i - {n - 1} AND a.i WHERE a.i >= {n - 1} GROUP BY 1, 2, 3),
cc{n} AS (SELECT symbol, i, dev / nullif({d(S.CCI_SCALE)} * mad, 0) AS "CCI{n}" FROM cd{n})""")
    joins = " ".join(f"LEFT JOIN cc{n} USING (symbol, i)" for n in S.CCI_LENGTHS)
    names = ", ".join(f'"CCI{n}"' for n in S.CCI_LENGTHS)
    return ",\n".join(ctes) + f",\ncci AS (SELECT symbol, ts, i, {names} FROM tp {joins})"


def feature_sql(group: str, bars: str) -> str:
    names = S.FEATURE_GROUPS[group]
    if group in _PLAIN:
        made = ", ".join(f'{e} AS "{n}"' for n, e in plain_exprs(group).items())
        shown = ", ".join(names) if group in UNROUNDED else rs(*names)
        return f"WITH {bars}, {POS}, f AS (SELECT symbol, ts, {made} FROM pos) SELECT symbol, ts, {shown} FROM f"
    if group in _LEVELS:
        return f"WITH {bars}, {POS}, {levels_sql(_LEVELS[group](), 'pos')} SELECT symbol, ts, {rs(*names)} FROM ld"
    if group == "rci":
        return f"WITH {bars}, {POS}, {rci_sql('pos')} SELECT symbol, ts, {rs(*names)} FROM rci"
    if group == "cci":
        return f"WITH {bars}, {POS}, {cci_sql('pos')} SELECT symbol, ts, {rs(*names)} FROM cci"
    head = f"WITH RECURSIVE {bars}, {POS}, {recursive_features('pos')}"
    if group == "ema":
        return f"{head} SELECT pos.symbol, pos.ts, {', '.join(r(f'emad.{n}', n) for n in names)} FROM pos JOIN emad USING (symbol, i)"
    return f"{head} SELECT symbol, ts, {rs(*names)} FROM exps"


for _group in S.FEATURE_GROUPS:
    ORACLES[f"feat_{_group}"] = feature_sql(_group, event_bars())
for _group in ("sma", "mom", "roc", "bb_width", "log_diff", "reg"):
    ORACLES[f"feat_lines_{_group}"] = feature_sql(_group, LINE_BARS)

_made = ", ".join(f'{e} AS "{n}"' for g in _PLAIN for n, e in plain_exprs(g).items())
_sources = {"ema": "emad", "atr": "exps", "rsi": "exps", "macd": "exps", "rci": "rci", "cci": "cci"}
_picked = []
for _group, _names in S.FEATURE_GROUPS.items():
    _source = _sources.get(_group, "ld" if _group in _LEVELS else "pl")
    _picked += [f'{_source}."{n}" AS "{n}"' for n in _names]
def digits(name: str) -> int:
    return 3 if name in PRICE_SCALED else FINE if name in LOGS else 6


_shown = ", ".join(f'"{n}"' if n in EXACT else r(f'"{n}"', n, digits(n)) for n in S.FEATURES)
_complete = " AND ".join(f'"{n}" IS NOT NULL' for n in S.FEATURES)


def feature_ctes(bars: str) -> str:
    """CTEs up to ``f`` with all features of every bar (WITH RECURSIVE needed)."""
    return f"""{bars}, {POS}, {recursive_features('pos')},
{rci_sql('pos')}, {cci_sql('pos')}, {levels_sql(sma_levels() | bb_levels() | reg_levels(), 'pos')},
pl AS (SELECT symbol, ts, i, {_made} FROM pos),
f AS (SELECT pos.symbol, pos.ts, {', '.join(f'pos.{c}' for c in S.OHLCV)}, {', '.join(_picked)}
  FROM pos JOIN pl USING (symbol, i) JOIN ld USING (symbol, i) JOIN exps USING (symbol, i)
  JOIN emad USING (symbol, i) JOIN rci USING (symbol, i) JOIN cci USING (symbol, i))"""


def all_features_sql(bars: str) -> str:
    return f"WITH RECURSIVE {feature_ctes(bars)} SELECT symbol, ts, {RAW}, {_shown} FROM f WHERE {_complete}"


ORACLES["feat_all"] = all_features_sql(event_bars(level=LEVEL))
ORACLES["stream_live_features"] = ORACLES["feat_all"]
ORACLES["feat_lines_all"] = all_features_sql(line_bars(LINE_LEVEL))

_volume = {
    f"volume_{n}": e.replace("close", "volume") for g in ("mom", "roc") for n, e in plain_exprs(g).items()
}
ORACLES["feat_target_volume"] = f"""WITH {event_bars()}, {POS}
SELECT symbol, ts, {', '.join(r(e, n) for n, e in _volume.items())} FROM pos"""

# -- signals, labels, backtest --------------------------------------------------------------------


def signal_ctes(length: int = ENTRY_LENGTH, point: float = ENTRY_POINT) -> str:
    return f"""sig AS (SELECT * FROM (SELECT *,
    max(high) {w(length)} * {d(1 + point / 100)} AS sell,
    min(low) {w(length)} * {d(1 - point / 100)} AS buy FROM pos) WHERE i >= {length})"""


def trial_ctes(trials: list[dict]) -> str:
    lengths = sorted({t["entry_length"] for t in trials})
    bands = ", ".join(f"max(high) {w(k)} AS h{k}, min(low) {w(k)} AS l{k}" for k in lengths)
    pick_h = " ".join(f"WHEN {k} THEN h{k}" for k in lengths)
    pick_l = " ".join(f"WHEN {k} THEN l{k}" for k in lengths)
    values = ", ".join(f"({t['trial']}::INTEGER, {t['entry_length']}::INTEGER, {d(t['entry_point'])})" for t in trials)
    return f"""trials AS (SELECT * FROM (VALUES {values}) AS t(trial, entry_length, entry_point)),
bands AS (SELECT *, {bands} FROM pos),
sigs AS (SELECT b.*, t.trial, t.entry_length, t.entry_point,
    (CASE t.entry_length {pick_h} END) * (1.0::DOUBLE + t.entry_point / 100.0::DOUBLE) AS sell,
    (CASE t.entry_length {pick_l} END) * (1.0::DOUBLE - t.entry_point / 100.0::DOUBLE) AS buy
  FROM bands b, trials t WHERE b.i >= t.entry_length)"""


def backtest_ctes(source: str, keys: str = "symbol", pyramiding: int = SEARCH.pyramiding) -> str:
    """CTEs from priced rows to ``bt`` with profit and pnl."""
    o = f"OVER (PARTITION BY {keys} ORDER BY i)"
    c = d(ACCOUNT.commission)
    return f"""b1 AS (SELECT * REPLACE (least(buy, lead(open) {o}) AS buy, greatest(sell, lead(open) {o}) AS sell),
    lead(open) {o} AS "limit" FROM {source}),
b2 AS (SELECT *, coalesce(low < lag(buy) {o}, false) AS "long", coalesce(high > lag(sell) {o}, false) AS "short" FROM b1),
b3 AS (SELECT *, CASE WHEN "long" = "short" THEN 0 WHEN "long" THEN 1 ELSE -1 END AS "order",
    CASE WHEN lead("short") {o} THEN sell WHEN lead("long") {o} THEN buy ELSE close END AS exec_price FROM b2),
b4 AS (SELECT *, coalesce(last_value(nullif("order", 0) IGNORE NULLS) {o}, 0) AS carried,
    coalesce(exec_price - lag(exec_price) {o}, 0) AS "return" FROM b3),
b5 AS (SELECT *, carried * lag(carried) {o} < 0 AS flip FROM b4),
b6 AS (SELECT *, sum(coalesce(flip, false)::INTEGER) {o} AS grp FROM b5),
b7 AS (SELECT *, greatest(least(sum("order") OVER (PARTITION BY {keys}, grp ORDER BY i), {pyramiding}), -{pyramiding})::DOUBLE
    / {d(pyramiding)} * {d(ACCOUNT.lot)} AS pos FROM b6),
b8 AS (SELECT *, exec_price * {c} / 100.0::DOUBLE * abs(pos - lag(pos) {o}) AS commission FROM b7),
b9 AS (SELECT *, "return" * pos - commission AS profit FROM b8),
bt AS (SELECT *, CASE WHEN profit IS NOT NULL THEN sum(profit) {o} END AS pnl FROM b9)"""


_BARS = f"{event_bars()}, {POS}"
_SIG = f"{_BARS}, {signal_ctes()}"
ORACLES["signal_band"] = f"WITH {_SIG} SELECT symbol, ts, {rs(*S.OHLCV, 'sell', 'buy')} FROM sig"
ORACLES["signal_trials"] = f"WITH {_BARS}, {trial_ctes(TRIALS)} SELECT symbol, trial, ts, {rs('sell', 'buy')} FROM sigs"


def label_sql(binary: bool, as_written: bool) -> str:
    def side(price: str, won: str) -> str:
        return f"CASE WHEN {price} = 0 THEN 0 WHEN {won} THEN 1 ELSE -1 END"

    buy = side("exec_price_buy", "exec_price_buy < next_close")
    sell = side("exec_price_sell", "exec_price_sell > next_close")
    if as_written:
        sell = "CASE WHEN exec_price_sell <> 0 AND 2 * exec_price_sell > next_close - 1 THEN 1 ELSE 0 END"
    if binary:
        buy, sell = f"(({buy}) = 1)::INTEGER", f"(({sell}) = 1)::INTEGER"
    return f"""WITH {_SIG}, {backtest_ctes('sig')},
lab AS (SELECT *, CASE WHEN lead("long") {w()} THEN buy ELSE 0 END AS exec_price_buy,
  CASE WHEN lead("short") {w()} THEN sell ELSE 0 END AS exec_price_sell, lead(close) {w()} AS next_close FROM b2)
SELECT symbol, ts, {rs('limit', 'buy', 'sell')}, "long", "short", {rs('exec_price_buy', 'exec_price_sell')},
  {buy} AS y_buy, {sell} AS y_sell FROM lab WHERE "limit" IS NOT NULL"""


ORACLES["label_three_class"] = label_sql(False, False)
ORACLES["label_binary"] = label_sql(True, False)
ORACLES["label_as_written"] = label_sql(True, True)

_BT = f"WITH {_SIG}, {backtest_ctes('sig')}"
ORACLES["backtest_rows"] = f"""{_BT} SELECT symbol, ts, "long", "short", "order",
  {rs('exec_price', 'return', 'pos', 'commission', 'profit', 'pnl')} FROM bt"""
ORACLES["backtest_pnl_curve"] = f"{_BT} SELECT symbol, ts, {rs('pnl')} FROM bt"
ORACLES["backtest_pnl"] = f"{_BT} SELECT symbol, {r('sum(profit)', 'pnl')} FROM bt GROUP BY 1"
_SR = "avg(profit) / nullif(stddev_pop(profit), 0)"
ORACLES["backtest_sr"] = f"{_BT} SELECT symbol, {r(_SR, 'sr')} FROM bt GROUP BY 1"
ORACLES["backtest_max_dd"] = f"""{_BT}, dd AS (SELECT symbol, max(pnl) {w()} - pnl AS fall FROM bt)
SELECT symbol, {r('max(fall)', 'max_dd')} FROM dd GROUP BY 1"""
ORACLES["backtest_lines_pnl"] = f"""WITH {LINE_BARS}, {POS}, {signal_ctes()}, {backtest_ctes('sig')}
SELECT symbol, {r('sum(profit)', 'pnl')}, {r(_SR, 'sr')} FROM bt GROUP BY 1"""
ORACLES["pnl_export"] = f"""{_BT} SELECT symbol, 'pnl' AS key,
  row_number() OVER (PARTITION BY symbol ORDER BY i) - 1 AS step, epoch_ms(ts) AS "timestamp", {r('pnl', 'value')}
FROM bt WHERE pnl IS NOT NULL"""
ORACLES["gated_backtest"] = f"""WITH {_SIG},
gated AS (SELECT * REPLACE (CASE WHEN close > open THEN buy ELSE buy - 10000 END AS buy,
  CASE WHEN close < open THEN sell ELSE sell + 10000 END AS sell) FROM sig), {backtest_ctes('gated')}
SELECT symbol, ts, {rs('buy', 'sell', 'pos', 'profit', 'pnl')} FROM bt"""
_newest = "i = n - 1"
ORACLES["live_gate"] = f"""WITH {_SIG} SELECT symbol, ts,
  {r('buy - (1 - (close > open)::INTEGER) * 10000', 'buy_limit_price')},
  {r('sell + (1 - (close < open)::INTEGER) * 10000', 'sell_limit_price')} FROM sig WHERE {_newest}"""

# -- folds, scaling, search -----------------------------------------------------------------------


def fold_cte(k: int, gap: int, size: int | None, cap: int | None, ratio: float | None) -> str:
    m = "n" if ratio is None else f"floor(n * {d(1 - ratio)})::BIGINT"
    test = f"(m // {k + 1})" if size is None else str(size)
    start = "0::BIGINT" if cap is None else f"greatest(0::BIGINT, test_start_i - {gap} - {cap})"
    return f"""series AS (SELECT symbol, any_value({m}) AS m FROM pos GROUP BY symbol),
f0 AS (SELECT symbol, fold::INTEGER AS fold, m, {test} AS size, m - ({k} - fold) * {test} AS test_start_i
  FROM series, range({k}) AS t(fold) WHERE m >= {k + 1} AND m - {gap} - {k} * {test} > 0),
folds AS (SELECT symbol, fold, {start} AS train_start_i, test_start_i - {gap} - 1 AS train_end_i,
  test_start_i, test_start_i + size - 1 AS test_end_i FROM f0)"""


_FOLDS = fold_cte(SEARCH.n_splits, SEARCH.gap, None, None, SEARCH.evaluate_ratio)
_BOUNDS = ("train_start", "train_end", "test_start", "test_end")
_BOUND_ROWS = """SELECT symbol, fold, {ids}, {times} FROM folds f {joins}""".format(
    ids=", ".join(f"{b}_i::BIGINT AS {b}_i" for b in _BOUNDS),
    times=", ".join(f"p_{b}.ts AS {b}_ts" for b in _BOUNDS),
    joins=" ".join(
        f"JOIN (SELECT symbol, i AS {b}_i, ts FROM pos) p_{b} USING (symbol, {b}_i)" for b in _BOUNDS
    ),
)
ORACLES["fold_bounds"] = f"WITH {_BARS}, {_FOLDS} {_BOUND_ROWS}"
ORACLES["fold_bounds_capped"] = f"WITH {_BARS}, {fold_cte(3, 2, 20, 60, None)} {_BOUND_ROWS}"
_M = f"floor(n * {d(1 - SEARCH.evaluate_ratio)})::BIGINT"
_HOLD = f"hold AS (SELECT symbol, min(ts) AS eval_start, max(ts) AS eval_end FROM pos WHERE i >= {_M} + {SEARCH.gap} GROUP BY symbol)"
ORACLES["holdout_bounds"] = f"WITH {_BARS}, {_HOLD} SELECT * FROM hold"
ORACLES["fold_rows"] = f"""WITH {_BARS}, {_FOLDS},
ranges AS (SELECT symbol, fold, 'train' AS role, train_start_i AS a, train_end_i AS z FROM folds
  UNION ALL SELECT symbol, fold, 'test', test_start_i, test_end_i FROM folds)
SELECT symbol, fold, role, count(*) AS rows, min(ts) AS first_ts, max(ts) AS last_ts, {r('sum(close)', 'sum_close')}
FROM ranges JOIN pos USING (symbol) WHERE i BETWEEN a AND z GROUP BY 1, 2, 3"""
_HISTORY = f"""WITH {_BARS}, {_FOLDS}, {_HOLD}, fb AS ({_BOUND_ROWS}),
hist AS (
  {' UNION ALL '.join(f"SELECT symbol, '{b}_index' AS key, floor(epoch({b}_ts))::DOUBLE AS value, fold::BIGINT AS step FROM fb" for b in _BOUNDS)}
  UNION ALL SELECT symbol, 'eval_start_index', floor(epoch(eval_start))::DOUBLE, 0 FROM hold
  UNION ALL SELECT symbol, 'eval_end_index', floor(epoch(eval_end))::DOUBLE, 0 FROM hold)"""
ORACLES["bound_metrics"] = f"{_HISTORY} SELECT * FROM hist"
ORACLES["fold_table"] = f"{_HISTORY} SELECT symbol, fold::BIGINT AS fold, {', '.join(f'{b}_ts AS {b}_index' for b in _BOUNDS)} FROM fb"
ORACLES["eval_bounds"] = f"WITH {_BARS}, {_HOLD} SELECT symbol, eval_start AS eval_start_index, eval_end AS eval_end_index FROM hold"

_SCALE = f"""first_train AS (SELECT pos.* FROM pos JOIN folds USING (symbol) WHERE fold = 0 AND i BETWEEN train_start_i AND train_end_i),
state AS ({' UNION ALL '.join(f"SELECT symbol, '{c}' AS column_name, avg({c}) AS mean, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS scale FROM first_train GROUP BY symbol" for c in S.OHLCV)})"""
ORACLES["scale_fit"] = f"""WITH {_BARS}, {_FOLDS}, {_SCALE} SELECT symbol, column_name AS "column", {rs('mean', 'scale')} FROM state"""
ORACLES["scale_increment"] = f"WITH {_BARS} " + " UNION ALL ".join(
    f"SELECT symbol, '{c}' AS \"column\", {r(f'avg({c})', 'mean')}, {r(f'CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END', 'scale')} FROM pos GROUP BY symbol"
    for c in S.OHLCV
)
_joined = " ".join(f"JOIN state s_{c} ON s_{c}.symbol = pos.symbol AND s_{c}.column_name = '{c}'" for c in S.OHLCV)
ORACLES["scale_apply"] = f"""WITH {_BARS}, {_FOLDS}, {_SCALE} SELECT pos.symbol, ts,
  {', '.join(r(f'(pos.{c} - s_{c}.mean) / s_{c}.scale', c) for c in S.OHLCV)} FROM pos {_joined}"""


def search_ctes(trials: list[dict], bars: str = _BARS, params: S.OptimizeParams = SEARCH) -> str:
    folds = fold_cte(params.n_splits, params.gap, params.test_size, params.max_train_size, params.evaluate_ratio)
    falls = "falls AS (SELECT *, max(pnl) OVER (PARTITION BY symbol, trial, fold ORDER BY i) - pnl AS fall FROM bt)"
    value = {"pnl": "sum(profit)", "sr": _SR, "max_dd": "max(fall)"}[params.optimize_target]
    worst = "DESC" if params.direction == "maximize" else "ASC"
    return f"""{bars}, {trial_ctes(trials)}, {folds},
sliced AS (SELECT sigs.*, fold FROM sigs JOIN folds USING (symbol) WHERE i BETWEEN train_start_i AND train_end_i),
{backtest_ctes('sliced', 'symbol, trial, fold')}, {falls},
scores AS (SELECT symbol, trial, fold, {value} AS metric FROM falls GROUP BY 1, 2, 3),
means AS (SELECT symbol, trial, avg(metric) AS metric FROM scores WHERE metric IS NOT NULL GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY metric {worst}, trial) AS rk FROM means WHERE metric IS NOT NULL),
best AS (SELECT symbol, trial, metric, entry_length, entry_point FROM ranked JOIN trials USING (trial) WHERE rk = 1)"""


_SEARCH = f"WITH {search_ctes(TRIALS)}"
ORACLES["grid_fold_scores"] = f"{_SEARCH} SELECT symbol, trial, fold, {rs('metric')} FROM scores"
_best = f"symbol, trial, {rs('metric')}, entry_length, {rs('entry_point')}"
for _name, _params in GRID_SEARCHES.items():
    ORACLES[_name] = f"WITH {search_ctes(TRIALS, params=_params)} SELECT {_best} FROM best"
ORACLES["grid_best"] = f"{_SEARCH} SELECT {_best} FROM best"
ORACLES["grid_lines_best"] = f"WITH {search_ctes(TRIALS, f'{LINE_BARS}, {POS}')} SELECT {_best} FROM best"
ORACLES["random_search"] = f"WITH {search_ctes(random_trials(SEARCH.n_trials, ACCOUNT.seed))} SELECT {_best} FROM best"
ORACLES["tuned_signals"] = f"{_SEARCH} SELECT sigs.symbol, ts, {r('sell', 'sell')}, {r('buy', 'buy')} FROM sigs JOIN best USING (symbol, trial)"
ORACLES["best_export"] = f"""{_SEARCH} SELECT symbol, 'best_entry_length' AS key, entry_length::DOUBLE AS value FROM best
UNION ALL SELECT symbol, 'best_entry_point', round(entry_point, 6) FROM best"""
ORACLES["best_parameters"] = f"{_SEARCH} SELECT symbol, entry_length, {rs('entry_point')} FROM best"
ORACLES["trial_export"] = f"""{_SEARCH}, wide AS (SELECT * FROM means JOIN trials USING (trial))
SELECT symbol, trial AS step, 'pnl' AS key, {r('metric', 'value')} FROM wide
UNION ALL SELECT symbol, trial, 'entry_length', entry_length::DOUBLE FROM wide
UNION ALL SELECT symbol, trial, 'entry_point', round(entry_point, 6) FROM wide"""



def proposal_sql() -> str:
    """Parzen proposals over the trials' means (CTE ``means``), candidate by candidate."""
    g, c, w, e = d(sampler.GOOD), sampler.CANDIDATES, d(sampler.WIDTH), d(sampler.POWER)
    lo, hi = SIGNAL_SPACE["entry_length"][1:]
    bottom, top = SIGNAL_SPACE["entry_point"][1:]
    span = f"(ln({d(top)}) - ln({d(bottom)}))"
    unit = {
        "entry_length": f"(entry_length - {d(lo)} + 0.5) / {d(hi - lo + 1)}",
        "entry_point": f"(ln(entry_point) - ln({d(bottom)})) / {span}",
    }
    names = list(SIGNAL_SPACE)

    def uniform(name: str, purpose: str) -> str:
        return f"(('0x' || substr(md5(concat_ws(':', '{ACCOUNT.seed}', trial, c, '{name}', '{purpose}')), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"

    def density(name: str, of: str) -> str:
        values = f"{of}_{name}"
        wide = f"({w} * pow(len({values}), {e}))"
        return f"((coalesce(list_sum(list_transform({values}, lambda x: greatest(0.0, 1.0 - abs(({unit[name]}) - x) / {wide}) / {wide})), 0.0) + 1.0) / (len({values}) + 1))"

    draws, moves, picks = [], [], []
    for n in names:
        draws += [f"floor({uniform(n, 'part')} * (len(good_{n}) + 1))::INTEGER AS part_{n}", f"{uniform(n, 'draw')} AS draw_{n}"]
        moves.append(
            f"good_{n}[part_{n} + 1] + {w} * pow(len(good_{n}), {e}) *"
            f" (CASE WHEN draw_{n} < 0.5 THEN sqrt(2.0 * draw_{n}) - 1.0 ELSE 1.0 - sqrt(2.0 * (1.0 - draw_{n})) END) AS moved_{n}"
        )
        picks.append(
            f"CASE WHEN part_{n} >= len(good_{n}) THEN draw_{n} WHEN moved_{n} < 0 THEN -moved_{n}"
            f" WHEN moved_{n} > 1 THEN 2.0 - moved_{n} ELSE moved_{n} END AS u_{n}"
        )
    lists = ", ".join(
        f"coalesce(list({unit[n]} ORDER BY rk) FILTER (rk {op} ceil(n * {g})), []) AS {of}_{n}"
        for n in names for of, op in (("good", "<="), ("rest", ">"))
    )
    score = " + ".join(f"ln({density(n, 'good')}) - ln({density(n, 'rest')})" for n in names)
    return f"""ordered AS (SELECT symbol, entry_length, entry_point, count(*) OVER (PARTITION BY symbol) AS n,
    row_number() OVER (PARTITION BY symbol ORDER BY metric DESC, trial) AS rk FROM means JOIN trials USING (trial)),
sets AS (SELECT symbol, {lists} FROM ordered GROUP BY symbol),
slots AS (SELECT *, {', '.join(draws)} FROM sets, range({TOLD}, {TOLD + PROPOSED}) t(trial), range({c}) k(c)),
moved AS (SELECT *, {', '.join(moves)} FROM slots),
placed AS (SELECT *, {', '.join(picks)} FROM moved),
tried AS (SELECT *, least(floor({d(lo)} + u_entry_length * {d(hi - lo + 1)}), {d(hi)})::INTEGER AS entry_length,
    exp(ln({d(bottom)}) + u_entry_point * {span}) AS entry_point FROM placed),
judged AS (SELECT *, {score} AS score FROM tried)
SELECT symbol, trial::INTEGER AS trial, entry_length, {r('entry_point', 'entry_point')} FROM judged
QUALIFY row_number() OVER (PARTITION BY symbol, trial ORDER BY score DESC, c) = 1"""


ORACLES["next_trials"] = f"WITH {search_ctes(random_trials(TOLD, ACCOUNT.seed))}, {proposal_sql()}"

# -- stored series, upserts, tracking, orders -----------------------------------------------------

ORACLES["pivot_fields"] = ORACLES["resample_15m"]
ORACLES["payload_bars"] = ORACLES["resample_15m"]
ORACLES["scan_measurement"] = f"""WITH {event_bars()} SELECT symbol, bar_ts AS ts, {RAW} FROM bars
WHERE symbol = 'click' AND bar_ts + INTERVAL '250 milliseconds' >= TIMESTAMP '{NOW}' - INTERVAL '7 days'"""
_hourly = """SELECT 'u' || (user_id % 10)::VARCHAR AS symbol, date_trunc('hour', ts) AS ts, max(value) AS top_{0}
  FROM events WHERE event_type = '{0}' GROUP BY 1, 2"""
ORACLES["align_series"] = "SELECT symbol, ts, {} FROM {}".format(
    rs(*[f"top_{k}" for k in EVENT_TYPES]),
    " FULL JOIN ".join(
        f"({_hourly.format(k)}) {k}" + (" USING (symbol, ts)" if j else "") for j, k in enumerate(EVENT_TYPES)
    ),
)
ORACLES["keep_latest_orders"] = f"""SELECT o_custkey::VARCHAR AS symbol, o_orderstatus AS side, o_orderdate AS ingest_ts,
  o_orderkey AS order_id, {r('o_totalprice', 'price')} FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC, o_totalprice DESC) = 1"""
ORACLES["latest_artifact"] = """SELECT max('data/' || event_type || '_' || strftime(ts, '%Y%m%d%H%M%S') || '.csv') AS path
FROM events WHERE event_type = 'click'"""
ORACLES["previous_run_tag"] = """WITH runs AS (SELECT o_orderkey::VARCHAR AS run_uuid, o_orderstatus, o_orderdate FROM orders),
newest AS (SELECT * FROM runs ORDER BY o_orderdate DESC, run_uuid LIMIT 12),
parents AS (SELECT *, row_number() OVER (ORDER BY o_orderdate DESC, run_uuid) AS rk FROM newest WHERE o_orderstatus NOT IN ('O', 'P'))
SELECT coalesce(max(md5(run_uuid)), '') AS value FROM parents WHERE rk = 2"""
_POSITIONS = """held AS (SELECT event_type AS symbol, ts, CASE WHEN user_id % 2 = 0 THEN 'Buy' ELSE 'Sell' END AS side,
  (event_id % 5) / 1000.0::DOUBLE AS size FROM events)"""
_lot, _cap = d(0.001), 3
_NEWEST_HELD = "last(side ORDER BY ts, side, size) AS side, last(size ORDER BY ts, side, size) AS size"
_ORDERS = f"""o AS (SELECT symbol, ts, 'buy' AS side, buy AS price, CASE WHEN held IS NULL THEN {_lot}
    WHEN size < {_lot} * {_cap} THEN CASE WHEN held = 'Buy' THEN {_lot} ELSE size + {_lot} END
    WHEN held = 'Sell' THEN {_lot} * {1 + _cap} END AS qty FROM j
  UNION ALL SELECT symbol, ts, 'sell', sell, CASE WHEN held IS NULL THEN {_lot}
    WHEN size < {_lot} * {_cap} THEN CASE WHEN held = 'Sell' THEN {_lot} ELSE size + {_lot} END
    WHEN held = 'Buy' THEN {_lot} * {1 + _cap} END FROM j)"""
ORACLES["order_plan"] = f"""WITH {_SIG}, {_POSITIONS},
cur AS (SELECT symbol, {_NEWEST_HELD} FROM held WHERE symbol <> 'view' GROUP BY 1),
j AS (SELECT sig.symbol, sig.ts, buy, sell, side AS held, size FROM sig LEFT JOIN cur USING (symbol) WHERE {_newest}),
{_ORDERS}
SELECT symbol, side, {rs('qty', 'price')} FROM o WHERE qty IS NOT NULL"""
# Closed bars: the watermark of the slower stream, ten minutes behind its newest row, has passed them.
ORACLES["stream_order_plan"] = f"""WITH {_SIG}, {_POSITIONS},
cur AS (SELECT symbol, time_bucket(INTERVAL '{INTERVAL}', ts) AS bar, {_NEWEST_HELD} FROM held WHERE symbol <> 'view' GROUP BY 1, 2),
edge AS (SELECT least((SELECT max(ts) FROM sig), (SELECT date_trunc('millisecond', max(ts)) FROM held WHERE symbol <> 'view')) - INTERVAL '10 minutes' AS edge),
j AS (SELECT sig.symbol, sig.ts, buy, sell, side AS held, size
  FROM edge, sig LEFT JOIN cur ON cur.symbol = sig.symbol AND bar = sig.ts WHERE sig.ts + INTERVAL '{INTERVAL}' <= edge),
{_ORDERS}
SELECT symbol, ts, side, {rs('qty', 'price')} FROM o WHERE qty IS NOT NULL"""
_MS = "date_trunc('millisecond', ts)"
ORACLES["payload_open_interest"] = f"SELECT event_type AS symbol, {_MS} AS ts, {r('value', 'open_interest')} FROM events"
ORACLES["payload_long_ratio"] = f"SELECT event_type AS symbol, {_MS} AS ts, {r('value', 'lsr')} FROM events"
ORACLES["payload_balance"] = f"""SELECT {_MS} AS ts, {r("CASE WHEN event_type <> 'error' THEN value END", 'balance')},
  event_type = 'error' AS is_error FROM events"""
ORACLES["payload_positions"] = f"WITH {_POSITIONS} SELECT {_MS} AS ts, side, {rs('size')}, 1.5::DOUBLE AS avg_price, symbol FROM held"
ORACLES["payload_open_orders"] = f"WITH {_POSITIONS} SELECT {_MS} AS ts, side, {r('size', 'price')}, symbol, 'model-1' AS model_source FROM held"
_weight = "count(*) OVER () / (2.0::DOUBLE * count(*) OVER (PARTITION BY y_{0}))"
ORACLES["class_weights"] = f"""WITH lab AS ({ORACLES['label_binary']})
SELECT symbol, ts, y_buy, y_sell, {r(_weight.format('buy'), 'weight_buy')}, {r(_weight.format('sell'), 'weight_sell')} FROM lab"""

# -- one long series over many blocks -------------------------------------------------------------

_LONG, _LONG_LEVEL = (event_bars(LONG_INTERVAL, level, whole=True) for level in (0.0, LEVEL))
_head = f"WITH RECURSIVE {_LONG_LEVEL}, {POS}, {recursive_features('pos')}"
for _suffix in ("", "_small_blocks"):
    for _group in ("ema", "rsi", "atr", "macd"):
        _from, _join = ("emad", "pos JOIN emad USING (symbol, i)") if _group == "ema" else ("exps", "exps")
        _cols = ", ".join(r(f'{_from}."{n}"', n, digits(n)) for n in S.FEATURE_GROUPS[_group])
        ORACLES[f"feat_long_{_group}{_suffix}"] = f"{_head} SELECT symbol, ts, {_cols} FROM {_join}"
    ORACLES[f"backtest_long{_suffix}"] = f"""WITH {_LONG}, {POS}, {signal_ctes()}, {backtest_ctes('sig')}
SELECT symbol, ts, "order", {', '.join(r(c, c, FINE) for c in ('pos', 'profit', 'pnl'))} FROM bt"""
    ORACLES[f"running_long{_suffix}"] = f"""WITH {_LONG}, {POS}
SELECT symbol, ts, {r(f'sum(volume) {w()}', 'total')} FROM pos"""
    ORACLES[f"grid_long{_suffix}"] = f"""WITH {search_ctes(TRIALS, f'{_LONG}, {POS}')}
SELECT symbol, trial, fold, {rs('metric')} FROM scores"""
ORACLES["feat_long_all"] = all_features_sql(_LONG_LEVEL)
_short = f"NOT (m >= {SEARCH.n_splits + 1} AND m - {SEARCH.gap} - {SEARCH.n_splits} * 105 > 0)"
ORACLES["left_out_series"] = f"""WITH {LINE_BARS}, {POS}, series AS (SELECT symbol, max(n) AS n, max({_M}) AS m FROM pos GROUP BY 1)
SELECT symbol, n FROM series WHERE {_short}"""

_LAYOUT = f"WHEN event_id % {BROKEN} = {CUT} THEN 'not of the layout' WHEN event_id % {BROKEN} = {EMPTY} THEN 'empty'"
ORACLES["payload_rejects"] = f"""SELECT kind, event_id, CASE {_LAYOUT}
  WHEN event_id % {BROKEN} = {OTHER} THEN CASE WHEN kind = 'balance' THEN 'bad ts' ELSE 'no entries' END
  WHEN event_id % {BROKEN} = {AMOUNT} THEN 'bad ' || amount
  WHEN event_id % {BROKEN} = {TIME} THEN CASE WHEN kind = 'balance' THEN 'not of the layout' ELSE 'bad ts' END END AS reason
FROM events, (VALUES ('bars', 'close'), ('open_interest', 'open_interest'), ('long_ratio', 'lsr'), ('balance', 'balance'),
  ('positions', 'size'), ('open_orders', 'price')) k(kind, amount)"""
ORACLES["stream_payload_files"] = f"""SELECT outcome, count(*) AS rows, {r("sum(CASE WHEN outcome = 'row' THEN value END)", 'total')}
FROM (SELECT value, CASE {_LAYOUT} WHEN event_id % {BROKEN} = {OTHER} THEN 'no entries'
  WHEN event_id % {BROKEN} = {AMOUNT} THEN 'bad open' ELSE 'row' END AS outcome FROM events) GROUP BY 1"""

# -- classifiers -----------------------------------------------------------------------------------

# Every feature is present from row 200 on: the price level keeps all bands above zero.
_MODEL = f"""{event_bars(INTERVAL, LEVEL, whole=True)}, {POS.replace('pos AS', 'allpos AS')},
pos AS (SELECT * REPLACE (i - 200 AS i, n - 200 AS n) FROM allpos WHERE i >= 200),
{signal_ctes(MODEL_LENGTH, MODEL_POINT)}"""
_held = f"held AS (SELECT * FROM sig WHERE i >= {_M} + {SEARCH.gap})"
ORACLES["classifier_rows"] = f"""WITH {_MODEL}, {_FOLDS}, {backtest_ctes('sig')},
lab AS (SELECT *, CASE WHEN lead("long") {w()} THEN buy ELSE 0 END AS eb,
  CASE WHEN lead("short") {w()} THEN sell ELSE 0 END AS es, lead(close) {w()} AS nc FROM b2)
SELECT symbol, ts, {rs('buy', 'sell')}, (eb <> 0 AND eb < nc)::INTEGER AS y_buy, (es <> 0 AND es > nc)::INTEGER AS y_sell
FROM lab JOIN folds USING (symbol)
WHERE "limit" IS NOT NULL AND fold = {SEARCH.n_splits - 1} AND i BETWEEN train_start_i AND train_end_i"""
ORACLES["classifier_holdout_base"] = f"""WITH {_MODEL}, {_held}, {backtest_ctes('held')}
SELECT symbol, ts, {rs('pos', 'profit', 'pnl')} FROM bt"""

# Boosted trees, one split at a time. The features are those of the whole series, scaled by the
# first fold's train range.
_FITTED = f"""allf AS (WITH RECURSIVE {feature_ctes(event_bars(INTERVAL, LEVEL, whole=True))}
  SELECT * FROM f WHERE {_complete}),
pos AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) - 1 AS i, count(*) OVER (PARTITION BY symbol) AS n FROM allf),
{signal_ctes(MODEL_LENGTH, MODEL_POINT)}, {_FOLDS}, {backtest_ctes('sig')},
lab0 AS (SELECT *, CASE WHEN lead("long") {w()} THEN buy ELSE 0 END AS eb,
  CASE WHEN lead("short") {w()} THEN sell ELSE 0 END AS es, lead(close) {w()} AS nc FROM b2),
lab AS (SELECT i, (eb <> 0 AND eb < nc)::INTEGER AS y_buy, (es <> 0 AND es > nc)::INTEGER AS y_sell
  FROM lab0 WHERE "limit" IS NOT NULL),
x AS (SELECT i, unnest(range({len(S.FEATURES)})) AS f, unnest([{', '.join(f'"{n}"' for n in S.FEATURES)}]) AS x FROM pos),
xs AS (SELECT f, avg(x) AS mean, CASE WHEN stddev_pop(x) = 0 THEN 1 ELSE stddev_pop(x) END AS scale
  FROM x, folds WHERE fold = 0 AND i BETWEEN train_start_i AND train_end_i GROUP BY f),
binned AS MATERIALIZED (SELECT i, f, len(list_filter([{', '.join(map(d, MODEL_EDGES))}], lambda e: e < (x - mean) / scale)) AS b
  FROM x JOIN xs USING (f) WHERE i IN (SELECT i FROM sig))"""


def boost_ctes(trials: list[dict], folds: list[int], rounds: int, rows: str) -> str:
    """CTEs up to ``s_{rounds} (model, i, score)`` and ``splits (model, turn, f, b, gain)``.

    One model per trial, fold and side, in this order. ``rows`` selects which (model, i) get scores
    besides the rows learnt from. Depth limits beyond the number of leaves are not needed here.
    """
    models, masks = [], []
    for t in trials:
        for fold in folds:
            for side in ("buy", "sell"):
                p = classifier(t, side)
                number = len(models)
                models.append(
                    f"({number}, {t.get('trial', 0)}, {fold}, '{side}', {d(p.learning_rate)}, {d(p.reg_alpha)},"
                    f" {d(p.reg_lambda)}, {p.min_child_samples}, {p.num_leaves})"
                )
                for turn in range(rounds):
                    used = boost.sampled_columns(
                        boost.Member(p, 0, fold, ACCOUNT.seed), turn, 0, len(S.FEATURES)
                    )
                    masks.append(f"({number}, {turn}, {sum(1 << k for k, u in enumerate(used) if u)})")
    grid = d(boost.GRID)
    part = "(greatest(abs({0}) - l1, 0.0) * greatest(abs({0}) - l1, 0.0) / ({1} + l2))"
    shrunk = "(sign(g) * greatest(abs(g) - l1, 0.0))"
    ctes = [
        f"models AS (SELECT * FROM (VALUES {', '.join(models)}) AS m(model, trial, fold, side, rate, l1, l2, least, leaves))",
        f"masks AS (SELECT * FROM (VALUES {', '.join(masks)}) AS m(model, turn, mask))",
        """learnt AS MATERIALIZED (SELECT model, i, CASE WHEN side = 'buy' THEN y_buy ELSE y_sell END AS y
  FROM models JOIN folds USING (fold) JOIN lab ON i BETWEEN train_start_i AND train_end_i)""",
        """sizes AS (SELECT model, count(*) AS total, count(*) FILTER (y = 1) AS ones FROM learnt GROUP BY 1)""",
        # A class without rows weighs one, and scores start at zero then.
        """weighed AS (SELECT model, total - ones AS zeros, ones,
    CASE WHEN total > ones THEN total / (2 * (total - ones))::DOUBLE ELSE 1.0 END AS w0,
    CASE WHEN ones > 0 THEN total / (2 * ones)::DOUBLE ELSE 1.0 END AS w1 FROM sizes)""",
        "shares AS (SELECT model, w0, w1, w0 * zeros AS s0, w1 * ones AS s1, zeros > 0 AND ones > 0 AS has_both FROM weighed)",
        f"scored AS MATERIALIZED (SELECT model, i FROM learnt UNION {rows})",
        """s_0 AS (SELECT model, i, CASE WHEN has_both THEN ln(s1 / (s0 + s1)) - ln(s0 / (s0 + s1)) ELSE 0.0 END AS score
  FROM scored JOIN shares USING (model))""",
    ]
    most = max(int(t[f"num_leaves_{side}"]) for t in trials for side in ("buy", "sell"))
    for turn in range(rounds):
        ctes.append(f"""g_{turn} AS MATERIALIZED (SELECT model, i,
    floor((1.0 / (1.0 + exp(-score)) - y) * (CASE WHEN y = 1 THEN w1 ELSE w0 END) * {grid} + 0.5)::BIGINT AS g,
    floor(1.0 / (1.0 + exp(-score)) * (1.0 - 1.0 / (1.0 + exp(-score))) * (CASE WHEN y = 1 THEN w1 ELSE w0 END) * {grid} + 0.5)::BIGINT AS h
  FROM learnt JOIN s_{turn} USING (model, i) JOIN shares USING (model))""")
        ctes.append(f"a_{turn}_0 AS (SELECT model, i, 0 AS leaf FROM scored)")
        for k in range(1, most):
            ctes.append(f"""h_{turn}_{k} AS (SELECT model, leaf, f, b, sum(g) AS g, sum(h) AS h, count(*) AS n
  FROM g_{turn} JOIN a_{turn}_{k - 1} USING (model, i) JOIN binned USING (i) JOIN masks USING (model) JOIN models USING (model)
  WHERE turn = {turn} AND (mask >> f) & 1 = 1 AND leaves > {k} GROUP BY ALL),
c_{turn}_{k} AS (SELECT model, leaf, f, b, sum(g) OVER u / {grid} AS gl, sum(h) OVER u / {grid} AS hl, sum(n) OVER u AS nl,
    sum(g) OVER v / {grid} AS gt, sum(h) OVER v / {grid} AS ht, sum(n) OVER v AS nt
  FROM h_{turn}_{k} WINDOW u AS (PARTITION BY model, leaf, f ORDER BY b), v AS (PARTITION BY model, leaf, f)),
e_{turn}_{k} AS (SELECT model, leaf, f, b, {part.format('gl', 'hl')} + {part.format('(gt - gl)', '(ht - hl)')} - {part.format('gt', 'ht')} AS gain
  FROM c_{turn}_{k} JOIN models USING (model)
  WHERE nl >= least AND nt - nl >= least AND hl >= 0.001 AND ht - hl >= 0.001),
best_{turn}_{k} AS MATERIALIZED (SELECT * FROM e_{turn}_{k} WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY model ORDER BY gain DESC, leaf, f, b) = 1),
a_{turn}_{k} AS MATERIALIZED (SELECT a.model, a.i, CASE WHEN x.b > s.b THEN {k} ELSE a.leaf END AS leaf
  FROM a_{turn}_{k - 1} a LEFT JOIN best_{turn}_{k} s ON s.model = a.model AND s.leaf = a.leaf
    LEFT JOIN binned x ON x.i = a.i AND x.f = s.f)""")
        ctes.append(f"""v_{turn} AS (SELECT model, leaf, -{shrunk} / (h + l2) * rate AS value
  FROM (SELECT model, leaf, sum(g) / {grid} AS g, sum(h) / {grid} AS h
    FROM g_{turn} JOIN a_{turn}_{most - 1} USING (model, i) GROUP BY 1, 2) JOIN models USING (model)
  WHERE model IN (SELECT model FROM best_{turn}_1)),
s_{turn + 1} AS MATERIALIZED (SELECT model, i, score + coalesce(value, 0.0) AS score
  FROM s_{turn} JOIN a_{turn}_{most - 1} USING (model, i) LEFT JOIN v_{turn} USING (model, leaf))""")
    every = " UNION ALL ".join(
        f"SELECT model, {turn} AS turn, f, b, gain FROM best_{turn}_{k}" for turn in range(rounds) for k in range(1, most)
    )
    return ",\n".join(ctes) + f",\nsplits AS ({every})"


_last = SEARCH.n_splits - 1
_pair = f"""WITH RECURSIVE {_FITTED},
{boost_ctes([MODEL_PARAMS], [_last], MODEL_ROUNDS, 'SELECT model, i FROM models, sig')},
names AS (SELECT unnest(range({len(S.FEATURES)})) AS f, unnest([{', '.join(f"'{n}'" for n in S.FEATURES)}]) AS feature)"""
ORACLES["boost_first_splits"] = f"""{_pair}
SELECT side, feature, b::INTEGER AS bin, {r('gain', 'gain')} FROM splits JOIN names USING (f) JOIN models USING (model) WHERE turn = 0"""
_both = """SELECT symbol, ts, {rounds}::INTEGER AS rounds, {buy}, {sell} FROM sig
JOIN s_{rounds} b USING (i) JOIN s_{rounds} s USING (i) WHERE b.model = 0 AND s.model = 1 AND i IN (SELECT i FROM lab)"""
ORACLES["boost_scores"] = _pair + " UNION ALL ".join(
    _both.format(rounds=n, buy=r("b.score", "score_buy"), sell=r("s.score", "score_sell")) for n in (1, MODEL_ROUNDS)
)
_held_scores = f"""held AS (SELECT sig.*, b.score AS score_buy, s.score AS score_sell, (b.score > 0)::INTEGER::DOUBLE AS pred_buy,
    (s.score > 0)::INTEGER::DOUBLE AS pred_sell
  FROM sig JOIN s_{MODEL_ROUNDS} b USING (i) JOIN s_{MODEL_ROUNDS} s USING (i) WHERE b.model = 0 AND s.model = 1)"""
ORACLES["classifier_predictions"] = f"""{_pair}, {_held_scores}
SELECT symbol, ts, {rs('score_buy', 'score_sell')}, pred_buy, pred_sell FROM held WHERE i >= {_M} + {SEARCH.gap}"""
ORACLES["classifier_importances"] = f"""{_pair}
SELECT side, feature, count(gain) AS importance, {r('coalesce(sum(gain), 0)', 'gain')}
FROM names JOIN models ON true LEFT JOIN splits USING (model, f) GROUP BY 1, 2"""
_GATED = """gated AS (SELECT * REPLACE (CASE WHEN pred_buy <> 0 THEN buy ELSE buy - 10000 END AS buy,
  CASE WHEN pred_sell <> 0 THEN sell ELSE sell + 10000 END AS sell) FROM {0})"""


def again(ctes: str) -> str:
    """Backtest CTEs a second time in one statement."""
    return re.sub(r"\b(b[1-9]|bt)\b", r"\1_gated", ctes)


ORACLES["classifier_holdout"] = f"""{_pair}, {_held_scores}, {_GATED.format('held')},
late AS (SELECT * FROM gated WHERE i >= {_M} + {SEARCH.gap}), {again(backtest_ctes('late'))}
SELECT symbol, ts, {rs('buy', 'sell', 'pos', 'profit', 'pnl')} FROM bt_gated"""
ORACLES["latest_scores"] = f"""{_pair}, {_held_scores}
SELECT symbol, ts, {r('buy - (1 - pred_buy) * 10000', 'buy_limit_price')}, {r('sell + (1 - pred_sell) * 10000', 'sell_limit_price')}
FROM held WHERE i = n - 1"""
_tested = "SELECT model, i FROM models JOIN folds USING (fold) JOIN lab ON i BETWEEN test_start_i AND test_end_i"
_trials_sql = f"""WITH RECURSIVE {_FITTED},
{boost_ctes(SEARCH_TRIALS, list(range(SEARCH.n_splits)), SEARCH_ROUNDS, _tested)},
paired AS (SELECT i, trial, fold, max(score) FILTER (side = 'buy') AS sb, max(score) FILTER (side = 'sell') AS ss
  FROM s_{SEARCH_ROUNDS} JOIN models USING (model) GROUP BY 1, 2, 3),
tested AS (SELECT sig.*, trial, fold, (sb > 0)::INTEGER AS pred_buy, (ss > 0)::INTEGER AS pred_sell
  FROM paired JOIN folds USING (fold) JOIN sig USING (i) WHERE i BETWEEN test_start_i AND test_end_i),
{_GATED.format('tested')}, {again(backtest_ctes('gated', 'trial, fold'))},
per_fold AS (SELECT any_value(symbol) AS symbol, trial, fold, {_SR} AS metric FROM bt_gated GROUP BY trial, fold),
scores AS (SELECT symbol, trial::INTEGER AS trial, avg(metric) AS metric FROM per_fold GROUP BY 1, 2)"""
ORACLES["classifier_search"] = f"{_trials_sql} SELECT symbol, trial, {rs('metric')} FROM scores"
_typed = ", ".join(
    f"{n}::INTEGER AS {n}" if kind == "int" else r(n, n) for n, kind in PARAMETER_TYPES.items()
)
_values = ", ".join(
    f"({t['trial']}, {', '.join(d(t[n]) for n in PARAMETER_TYPES)})" for t in SEARCH_TRIALS
)
ORACLES["best_classifier_parameters"] = f"""{_trials_sql},
winner AS (SELECT coalesce((SELECT trial FROM scores WHERE metric IS NOT NULL ORDER BY metric DESC, trial LIMIT 1), 0) AS trial)
SELECT 'run' AS run_id, {_typed} FROM (VALUES {_values}) t(trial, {', '.join(PARAMETER_TYPES)}) JOIN winner USING (trial)"""

# -- written and read back ------------------------------------------------------------------------

_mom = ", ".join(f'{e} AS "{n}"' for n, e in plain_exprs("mom").items())
ORACLES["feature_files"] = f"""WITH {event_bars()}, {POS}, f AS (SELECT symbol, ts, {RAW}, {_mom} FROM pos)
SELECT symbol, ts, {rs(*S.OHLCV, *S.FEATURE_GROUPS['mom'])} FROM f"""
ORACLES["scan_relation"] = "SELECT c_custkey, c_name FROM customer WHERE c_nationkey = 3"
ORACLES["job_log"] = """SELECT DISTINCT 'recorder' AS name, 'pulled ' || event_type AS message, event_type AS entry FROM events"""
